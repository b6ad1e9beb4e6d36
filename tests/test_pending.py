from framequarry import cli


def test_pending_gives_all_ids(spark, tmp_path, capfd):
    ids = [f"{i:011d}" for i in range(1205)]
    (tmp_path / "urls.txt").write_text("".join(f"{i}\n" for i in ids))
    (tmp_path / "done.txt").write_text("".join(f"youtube {i}\n" for i in ids[:3]))
    args = ["pending", str(tmp_path / "urls.txt"), "--ledger", str(tmp_path / "done.txt")]
    assert cli.main(args) == 0
    assert [x for x in capfd.readouterr().out.splitlines() if x in set(ids)] == ids[3:]
    assert cli.main([*args, "--out", str(tmp_path / "out")]) == 0
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ids[3:]


def test_resolve_take_and_ls(spark, tmp_path, capfd):
    ids = [f"{i:011d}" for i in range(9)]
    (tmp_path / "urls.txt").write_text("".join(f"{i}\n" for i in ids))
    (tmp_path / "done.txt").write_text(f"youtube {ids[0]}\n")
    urls, log = str(tmp_path / "urls.txt"), str(tmp_path / "log")

    def run(*args):
        assert cli.main(list(args)) == 0
        return [x for x in capfd.readouterr().out.splitlines() if x in set(ids) or x.split(" ")[0] in ("attempts", "claims", "out")]

    assert run("resolve", urls, log, "--ledger", str(tmp_path / "done.txt"), "--batch", "3") == ids[1:4]
    assert run("resolve", urls, log, "--ledger", str(tmp_path / "done.txt"), "--batch", "3") == ids[4:7]
    assert run("take", urls, log, "--worker", "w", "--most", "2") == ids[:2]
    assert run("take", urls, log, "--worker", "v", "--most", "2") == ids[2:4]
    assert run("ls", log) == ["attempts 6", "claims 4", "out 6"]
