"""Model interface, deterministic stand-ins and their registry.

A model is a function from a list of inputs to a list of replies, made once for each Python worker by a factory, so that
weights are loaded once. Real models plug in by name; the stand-ins depend on nothing but the text they are given.
"""

from __future__ import annotations

import json
import time
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framequarry.functions.text import RETRYABLE_HTTP, batch_json

Model = Callable[[list[str]], list[str | None]]
_registry: dict[str, Callable[[], Model]] = {}


def register(name: str, factory: Callable[[], Model]) -> None:
    _registry[name] = factory


def model(name: str) -> Callable[[], Model]:
    if name not in _registry:
        raise KeyError(f"no model {name!r}; known: {', '.join(sorted(_registry))}")
    return _registry[name]


def caller(name: str, batch: int = 24, attempts: int = 3):
    """A Series-iterator function: replies of the model in batches; a batch that fails is tried again, then one by one."""
    factory = model(name)

    @F.pandas_udf("struct<raw:string,error:string>")
    def call(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        run = factory()
        for s in parts:
            texts = ["" if t is None else t for t in s]
            out = [r for i in range(0, len(texts), batch) for r in ladder(run, texts[i : i + batch], attempts)]
            yield pd.DataFrame(out, columns=["raw", "error"], index=s.index)

    return call


def ladder(run: Model, texts: list[str], attempts: int = 2) -> list[tuple[str | None, str | None]]:
    """Whole batch, again, then single items; what still fails is an error of that item alone."""
    for _ in range(attempts):
        try:
            got = run(texts)
            if len(got) == len(texts) and all(g is not None for g in got):
                return [(g, None) for g in got]
        except Exception:
            continue
    out = []
    for t in texts:
        try:
            got = run([t])
            out.append((got[0], None) if got and got[0] is not None else (None, "no reply"))
        except Exception as e:
            out.append((None, str(e)[:300]))
    return out


Call = Callable[[str], tuple[int, str | None, dict[str, int]]]


def call_with_retry(call: Call, text: str, attempts: int = 4, wait: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None, int, int, dict[str, int]]:
    """raw, error, status, tries and usage of a call that answers (HTTP status, text, usage). Statuses that may pass are tried
    again after ``2^n`` seconds, 60 at most; others, and the last one, end as an error. Usage adds up over tries."""
    used: dict[str, int] = {}
    for n in range(attempts):
        status, raw, usage = call(text)
        for k, v in usage.items():
            used[k] = used.get(k, 0) + v
        if status == 200:
            return raw, None, status, n + 1, used
        if status not in RETRYABLE_HTTP or n + 1 == attempts:
            return None, f"HTTP {status}", status, n + 1, used
        wait(min(60.0, 2.0**n))
    raise ValueError("attempts has to be at least 1")


def call_column(factory: Callable[[], Call], attempts: int = 4, wait: Callable[[float], None] = time.sleep):
    """A Series-iterator function: ``call_with_retry`` of each input; the client is made once for each Python worker."""

    @F.pandas_udf("struct<raw:string,error:string,status:int,tries:int,usage:map<string,bigint>>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        call = factory()
        for s in parts:
            yield pd.DataFrame([call_with_retry(call, t or "", attempts, wait) for t in s], columns=["raw", "error", "status", "tries", "usage"], index=s.index)

    return run


def indexed(factory: Callable[[], Model]) -> Callable[[], Model]:
    """A batch model out of one for single texts: a request is JSON ``[{"i": 0, "text": ...}]``, its reply ``[{"i": 0, "v": ...}]``."""

    def make() -> Model:
        run = factory()

        def answer(requests: list[str]) -> list[str | None]:
            out = []
            for request in requests:
                items = json.loads(request)
                out.append(json.dumps([{"i": x["i"], "v": v} for x, v in zip(items, run([x["text"] for x in items]))]))
            return out

        return answer

    return make


def ask_batches(texts: DataFrame, text: str, name: str, size: int, whole: bool = True) -> DataFrame:
    """``text`` and the reply ``v`` of a batch model, asked for ``size`` distinct texts at a time.

    Replies are joined by batch and index. With ``whole``, a batch counts only if every index is answered once and none
    beyond; without, each first answer of a requested index counts. Texts without a reply have no row and can be asked again.
    """
    from framequarry.operators import joins, shard

    rows = shard.batches(texts.select(text).where(F.col(text).isNotNull()).distinct(), text, size)
    asked = rows.groupBy("batch").agg(batch_json(F.struct("i", F.col(text).alias("text"))).alias("request"))
    got = asked.select("batch", caller(name, 1)(F.col("request")).alias("r"))
    items = got.select("batch", F.explode(F.from_json("r.raw", "array<struct<i:int,v:string>>")).alias("x")).select("batch", "x.i", "x.v")
    if whole:
        return joins.aligned(rows, items).select(text, "v")
    first = items.where("v is not null and i is not null").groupBy("batch", "i").agg(F.first("v").alias("v"))
    return rows.join(first, ["batch", "i"]).select(text, "v")


def prompt(base: str, title: Column, url: Column) -> Column:
    """The base prompt, with the video's title and address as context where there are any (null is no text, H11)."""
    t, u = F.coalesce(title, F.lit("")), F.coalesce(url, F.lit(""))
    return F.when((t == "") & (u == ""), F.lit(base)).otherwise(F.concat(F.lit(base + "From a video named <"), t, F.lit("> at <"), u, F.lit(">; this only tells where the image comes from.\n")))


def _by_hash(*choices: str) -> Callable[[], Model]:
    return lambda: lambda texts: [choices[zlib.crc32(t.encode()) % len(choices)] for t in texts]


def _detect() -> Model:
    def run(texts: list[str]) -> list[str | None]:
        out = []
        for t in texts:
            h = zlib.crc32(t.encode())
            box = [h % 400, h // 400 % 400, 500 + h % 400, 500 + h // 7 % 500]
            out.append(json.dumps({"drop": h % 10 == 0, "drop_reason": "graphic" if h % 10 == 0 else "none", "caption": f"frame {h}", "boxes": [{"label": "logo", "box": box}] if h % 3 else []}))
        return out

    return run


register("people_yes_no", _by_hash("NO", "YES.", "no", "None visible", "people", "maybe"))
register("address", lambda: lambda texts: [f"https://v.example/{t}" for t in texts])
register("keep_drop", _by_hash("KEEP", "DROP", "farm", "keep or drop"))
register("detect", _detect)
register("describe", lambda: lambda texts: [json.dumps({"descriptive_text": f"a view of {zlib.crc32(t.encode()) % 1000}"}) for t in texts])
register("flag", indexed(lambda: lambda texts: [str(int(zlib.crc32(t.encode()) % 2)) for t in texts]))
register("rewrite", indexed(lambda: lambda texts: [t.replace("logo", "").replace("text", "").strip() or "plain" for t in texts]))
register("person_boxes", lambda: lambda texts: [json.dumps([{"cls": 0, "conf": zlib.crc32(t.encode()) % 100 / 100}]) for t in texts])


def cascade(df: DataFrame, text: str, prefilter: str, flag_model: str, rewrite_model: str, scratch: str, flags: DataFrame | None = None, cleans: DataFrame | None = None, size: int = 40) -> tuple[DataFrame, DataFrame]:
    """Flags and cleans of distinct texts: regex prefilter, flag, rewrite of what is flagged, both in indexed batches of ``size``
    of which only those that are answered whole count.

    Each step is written under ``scratch`` before the next reads it, so that no model runs twice; texts that an earlier
    run has flagged or rewritten aren't asked again.
    """
    spark = df.sparkSession
    unique = df.select(F.col(text)).where(F.col(text).rlike(prefilter)).distinct()
    ask = unique.join(flags.select(text), text, "left_anti") if flags is not None else unique
    got = ask_batches(ask, text, flag_model, size).where("v in ('0', '1')").select(text, F.col("v").cast("int").alias("flag"))
    got.write.mode("overwrite").parquet(f"{scratch}/flags")
    new = spark.read.parquet(f"{scratch}/flags")
    all_flags = new if flags is None else flags.select(text, "flag").unionByName(new)
    hot = all_flags.where("flag = 1").select(text)
    done = None if cleans is None else cleans.where("clean <> ''").select(text)
    ask = hot if done is None else hot.join(done, text, "left_anti")
    got = ask_batches(ask, text, rewrite_model, size).where("v is not null").select(text, F.col("v").alias("clean"))
    got.write.mode("overwrite").parquet(f"{scratch}/cleans")
    fresh = spark.read.parquet(f"{scratch}/cleans")
    return all_flags, fresh if cleans is None else cleans.select(text, "clean").unionByName(fresh)
