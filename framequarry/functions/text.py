"""Text expressions: trimming, truncation, verdicts of model replies, error classes, JSON in replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word lists that decide which texts speak of overlays and which download errors mean what.
TEXTY = (
    r"(?i)\b(watermarks?|logos?|logotypes?|labels?|labell?ed|printed|prints?|printing"
    r"|signage|signboards?|signs?|banners?|subtitles?|captions?|overlays?|texts?"
    r"|wording|lettering|inscriptions?|writing|written|placards?|posters?"
    r"|billboards?|tickers?|stickers?|seals?|stamps?|screen|screenshot)\b"
    r"|\bon screen\b|\bthe image\b|\bthis image\b|\bin the corner\b"
    r"|\bat the bottom\b|\bforeground text\b"
)
STRONG = (
    r"(?i)\blower.?third\b|\bticker\b|\bon.?screen\b|\btext overlay\b|\boverlay\b|"
    r"\bscreenshot\b|\bwatermark\b|\bsubtitle\b|\bcredits?\b|\bUI\b|"
    r"\bimage shows\b|\bsplit[- ]image\b|\bsplit[- ]screen\b|\bchannel bug\b"
)
PERMANENT = "private video|video unavailable|has been removed|removed by the uploader|account associated|terminated|does not exist|members-only|Join this channel|age-restricted|copyright"
THROTTLED = "429|Too Many Requests|Sign in to confirm|not a bot|blocked it in your country|failed to extract any player response|The following content is not available"
RETRYABLE_HTTP = (429, 500, 502, 503, 504)
CAPTION_LIMIT, DESCRIPTION_LIMIT, ERROR_LIMIT = 400, 800, 300


def strip(c: Column) -> Column:
    """All white space off both ends, Unicode included; ``trim`` takes spaces only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def cut(c: Column, n: int) -> Column:
    """Stripped, at most n characters, null if empty."""
    return F.nullif(F.left(strip(c), F.lit(n)), F.lit(""))


def verdict_yes_no(raw: Column) -> Column:
    """YES first or PEOPLE anywhere drops; NO first or NONE anywhere keeps; in this precedence, else UNCLEAR."""
    up = F.upper(F.coalesce(raw, F.lit("")))
    first = F.regexp_extract(up, "[A-Z]+", 0)
    return F.when((first == "YES") | up.contains("PEOPLE"), "DROP").when((first == "NO") | up.contains("NONE"), "KEEP").otherwise("UNCLEAR")


def verdict_keep_drop(raw: Column) -> Column:
    """DROP anywhere wins, then KEEP, FARM and CROP keep, anything else drops."""
    up = F.upper(F.coalesce(raw, F.lit("")))
    return F.when(up.contains("DROP"), "DROP").when(up.rlike("KEEP|FARM|CROP"), "KEEP").otherwise("DROP")


def error_class(message: Column, permanent: str = PERMANENT, throttled: str = THROTTLED) -> Column:
    return F.when(message.rlike(f"(?i){permanent}"), "permanent").when(message.rlike(f"(?i){throttled}"), "throttled").otherwise("transient")


def retryable(status: Column) -> Column:
    return status.isin(*RETRYABLE_HTTP)


def first_http_line(output: Column) -> Column:
    return F.try_element_at(F.filter(F.split(output, "\n"), lambda x: x.startswith("http")), F.lit(1))


def unfence(raw: Column) -> Column:
    """Without Markdown code fences."""
    return strip(F.regexp_replace(strip(raw), r"(?m)^```(?:json)?|```$", ""))


def json_variant(raw: Column) -> Column:
    """The reply as VARIANT: whole, else from the first brace to the last, else null."""
    t = unfence(raw)
    return F.coalesce(F.try_parse_json(t), F.try_parse_json(F.nullif(F.regexp_extract(t, r"(?s)\{.*\}", 0), F.lit(""))))


def truthy(v: Column, path: str) -> Column:
    """Python's truth of a member: false, 0, "", null and empty containers are false; "false", "[]" and "{}" are true."""
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    as_text = F.try_variant_get(v, path, "string")
    number = F.try_variant_get(v, path, "double")
    empty = ((kind == "STRING") & (as_text == "")) | (kind.startswith("ARRAY") & (as_text == "[]")) | (kind.startswith("OBJECT") & (as_text == "{}"))
    false = kind.isNull() | (kind == "VOID") | empty | ((kind == "BOOLEAN") & (as_text == "false")) | (~kind.isin("STRING", "BOOLEAN") & F.coalesce(number == 0, F.lit(False)))
    return ~F.coalesce(false, F.lit(True))


def drop_reason(reason: Column) -> Column:
    return F.when(reason.isin("none", "null", ""), None).otherwise(reason)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(part / F.greatest(F.lit(1), whole) * 100, digits)


def date_text(ts: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """A time as text; null stays null."""
    return F.date_format(ts, pattern)


def size_text(n_bytes: Column) -> Column:
    """Bytes as ``1.5 GB`` or ``12.0 MB``: gigabytes (2^30) from one on, else megabytes (2^20)."""
    gb = n_bytes / float(1 << 30)
    return F.when(gb >= 1, F.format_string("%.1f GB", gb)).otherwise(F.format_string("%.1f MB", n_bytes / float(1 << 20)))


def batch_json(items: Column) -> Column:
    """JSON of a batch: an array of structs, sorted."""
    return F.to_json(F.array_sort(F.collect_list(items)))
