import pytest

from quarry.sources import judgments as SJ
from quarry.sources import runs as SR
from quarry.sources import tsv as ST

TRAPS = ['"quoted start', "back\\slash", "# hash", "two\ttabs\there", "café ünï", "multi\nline\r\ntext"]


def test_tsv_traps_roundtrip(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TRAPS)), "id bigint, text string")
    path = str(tmp_path / "t")
    ST.write_id_text_tsv(df, path)
    back = {r["id"]: r["text"] for r in ST.read_id_text_tsv(spark, path).collect()}
    for i, t in enumerate(TRAPS):
        assert back[i] == t.replace("\r", " ").replace("\n", " ")


@pytest.mark.parametrize("fmt", ["triples", "trec"])
def test_qrels_roundtrip(spark, tmp_path, fmt):
    q = spark.createDataFrame([(1, 2, 0), (1, 3, 2), (4, 5, 1)], "qid bigint, pid bigint, rel int")
    path = str(tmp_path / fmt)
    SJ.write_qrels(q, path, fmt)
    back = SJ.read_qrels(spark, path, fmt, validate=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, q.collect()))


def test_qrels_bad_format(spark):
    with pytest.raises(ValueError):
        SJ.read_qrels(spark, "/nonexistent", "guess")


@pytest.mark.parametrize("fmt", ["parquet", "tsv", "tsv2"])
def test_run_roundtrip(spark, tmp_path, fmt):
    rows = [(q, 1000 - r, r, float(-r)) for q in range(3) for r in range(1, 50)]
    run = spark.createDataFrame(rows, "qid bigint, pid bigint, rank bigint, score double")
    path = str(tmp_path / fmt)
    SR.write_run(run, path, fmt, n_files=4)
    back = SR.read_run(spark, path, fmt)
    cols = ["qid", "pid", "rank"]
    assert sorted(map(tuple, back.select(cols).collect())) == sorted(map(tuple, run.select(cols).collect()))


def test_load_or_build_reuses(spark, tmp_path):
    run = spark.createDataFrame([(1, 2, 1, 0.5)], "qid bigint, pid bigint, rank bigint, score double")
    path = str(tmp_path / "cached")
    calls = []

    def build():
        calls.append(1)
        return run
    SR.load_or_build_run(spark, path, build)
    again = SR.load_or_build_run(spark, path, build)
    assert len(calls) == 1 and again.count() == 1


def test_tsv_bad_lines_raise_or_are_counted(spark, tmp_path):
    p = tmp_path / "raw.tsv"
    p.write_text("1\tfirst\nno tab here\nx\tbad id\n\n2\t\n3\tthird\twith tab\n")
    with pytest.raises(Exception, match="no tab here|bad id|not an id"):
        ST.read_id_text_tsv(spark, str(p)).collect()
    got = sorted(map(tuple, ST.read_id_text_tsv(spark, str(p), on_bad="drop").collect()))
    assert got == [(1, "first"), (2, ""), (3, "third\twith tab")]
    assert ST.count_bad_lines(spark, str(p)) == 3
    with pytest.raises(ValueError):
        ST.read_id_text_tsv(spark, str(p), on_bad="guess")


def test_tsv_carriage_returns_and_null_text(spark, tmp_path):
    p = tmp_path / "cr.tsv"
    p.write_bytes(b"1\talpha\rbeta gamma\r\n2\tx\n")
    assert sorted(map(tuple, ST.read_id_text_tsv(spark, str(p)).collect())) == [(1, "alpha\rbeta gamma"), (2, "x")]
    df = spark.createDataFrame([(1, None), (2, "t")], "id bigint, text string")
    ST.write_id_text_tsv(df, str(tmp_path / "w"))
    assert sorted(map(tuple, ST.read_id_text_tsv(spark, str(tmp_path / "w")).collect())) == [(1, ""), (2, "t")]


def test_rankless_run_orders_files_by_part_number(spark, tmp_path):
    for part, pid in ((99999, 1), (100000, 2), (100001, 3)):
        (tmp_path / f"part-{part}-x.txt").write_text(f"7\t{pid}\n")
    got = sorted(map(tuple, SR.read_run(spark, str(tmp_path), "tsv2").collect()))
    assert got == [(7, 1, 1), (7, 2, 2), (7, 3, 3)]
