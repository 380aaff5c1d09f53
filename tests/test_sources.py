import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lexiflow.operators import prep
from lexiflow.sources import fixtures as fx
from lexiflow.sources.tables import keep_encoded, read_records, read_split, write_encoded
from lexiflow.sources.text_files import read_lines, read_parallel, write_lines
from tests.conftest import SF_SMALL


def _write(path, data: bytes):
    with open(path, "wb") as f:
        f.write(data)


@pytest.mark.parametrize("src,tgt", [
    (b"a\nb\nc\n", b"x\ny\nz\n"),
    (b"a\n\nc", b"x\ny\nz\n"),          # blank line in the middle, no final newline
    (b"a\r\nb\r\nc\r\n", b"x\ry\rz"),   # CRLF and CR endings
])
def test_read_parallel_pairs_by_position(spark, tmp_path, src, tgt):
    _write(tmp_path / "train.en", src)
    _write(tmp_path / "train.es", tgt)
    got = sorted((r.line_no, r.src, r.tgt) for r in read_parallel(spark, str(tmp_path / "train"), "en", "es", "train").collect())
    exp_src = src.decode().splitlines()
    exp_tgt = tgt.decode().splitlines()
    assert got == [(i, s, t) for i, (s, t) in enumerate(zip(exp_src, exp_tgt))]


def test_read_parallel_misaligned_fails(spark, tmp_path):
    _write(tmp_path / "dev.en", b"a\nb\nc\n")
    _write(tmp_path / "dev.es", b"x\ny\n")
    with pytest.raises(Exception, match="not aligned"):
        read_parallel(spark, str(tmp_path / "dev"), "en", "es", "validation").collect()


def test_read_lines_keeps_order_over_many_splits(spark, tmp_path):
    lines = [f"line {i}" for i in range(20000)]
    _write(tmp_path / "big.txt", ("\n".join(lines) + "\n").encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        got = read_lines(spark, str(tmp_path / "big.txt"))
        assert got.rdd.getNumPartitions() >= 1
        rows = sorted((r.line_no, r.text) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == list(enumerate(lines))


def test_records_write_and_read_split(spark, tmp_path):
    recs = fx.records(spark, SF_SMALL)
    path = str(tmp_path / "records")
    write_encoded(recs, path)
    back = read_records(spark, path)
    assert back.count() == recs.count()
    test = read_split(back, "test")
    assert {r.split for r in test.select("split").distinct().collect()} == {"test"}
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()


def test_read_records_rejects_null_text(spark, tmp_path):
    path = str(tmp_path / "bad")
    spark.createDataFrame([("train", 1, None, "s")], "split string, row_id long, document string, summary string").write.parquet(path)
    with pytest.raises(Exception, match="null text"):
        read_records(spark, path).collect()


def test_fixture_shapes(spark):
    assert fx.pairs(spark, SF_SMALL).columns == ["split", "line_no", "src", "tgt"]
    v = fx.vocab(spark, SF_SMALL)
    ids = [r.id for r in v.orderBy("id").collect()]
    assert ids[0] == fx.FIRST_TOKEN_ID and ids == list(range(fx.FIRST_TOKEN_ID, fx.FIRST_TOKEN_ID + len(ids)))
    rm = fx.run_metrics(spark, SF_SMALL)
    assert rm.where(F.col("epoch") < 0).count() == 0


def test_checkpoint_dir_comes_from_the_session(spark):
    from lexiflow.session import ensure_checkpoint_dir

    path = ensure_checkpoint_dir(spark)
    assert path and spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == path  # set once, then read back


def test_read_records_json_with_schema(spark, tmp_path):
    recs = fx.records(spark, SF_SMALL)
    path = str(tmp_path / "records_json")
    recs.write.json(path)
    back = read_records(spark, path, fmt="json")
    assert back.schema.names == ["split", "row_id", "document", "summary"]
    assert back.count() == recs.count()
    assert sorted(r.row_id for r in back.where("split = 'validation'").collect()) == sorted(
        r.row_id for r in recs.where("split = 'validation'").collect())


def test_lines_of_several_files_count_through_by_name(spark, tmp_path):
    """Unequal part files (Spark packs the larger first): line i of one side meets line i of the other."""
    for side, cuts in (("en", (3, 500, 7)), ("es", (400, 10, 100))):
        folder = tmp_path / f"train.{side}"
        folder.mkdir()
        at = 0
        for k, n in enumerate(cuts):
            (folder / f"part-{k}.txt").write_text("".join(f"{side} {i}\n" for i in range(at, at + n)))
            at += n
    rows = read_parallel(spark, str(tmp_path / "train"), "en", "es", "train").collect()
    assert sorted((r.line_no, r.src, r.tgt) for r in rows) == [(i, f"en {i}", f"es {i}") for i in range(510)]


def _sides(spark, src, tgt):
    return (spark.createDataFrame(src, "split string, line_no long, src string"), spark.createDataFrame(tgt, "split string, line_no long, tgt string"))


def test_pair_aligned_fails_in_the_join_or_counts(spark):
    src, tgt = _sides(spark, [("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z")], [("a", 0, "X"), ("b", 0, "Z"), ("b", 5, "W")])
    with pytest.raises(Exception, match="not aligned"):
        prep.pair_aligned(src, tgt).collect()
    seen = Observation()
    got = sorted(map(tuple, prep.pair_aligned(src, tgt, observation=seen).collect()))
    assert got == [("a", 0, "x", "X"), ("b", 0, "z", "Z")]
    assert seen.get == {"n_src": 3, "n_tgt": 3, "only_src": 1, "only_tgt": 1, "first_bad": 1}
    report = {r.split: tuple(r)[1:] for r in prep.alignment_report(src, tgt).collect()}
    assert report == {"a": (2, 1, 1, 0, 1), "b": (1, 2, 0, 1, 5)}
    same, _ = _sides(spark, [("a", 0, "x"), ("a", 1, None)], [])
    assert prep.pair_aligned(same, same.withColumnRenamed("src", "tgt")).count() == 2  # a null text is a line


def test_escaped_lines_round_trip(spark, tmp_path):
    texts = ["plain", "", "two\nlines", "\r\n", "back\\slash \\n not a line end", "\\b\\\n", "\\", "ends with \\\r", "é\u2028x"] * 40
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(7)
    for parts in (1, 5):
        write_lines(df.coalesce(parts), "t", ["i"], str(tmp_path / f"l{parts}"))
        got = sorted((r.line_no, r.text) for r in read_lines(spark, str(tmp_path / f"l{parts}"), escaped=True).collect())
        assert got == list(enumerate(texts))


def test_kept_set_hit_miss_change_and_crash(spark, tmp_path):
    source, kept = tmp_path / "in", str(tmp_path / "kept")
    source.mkdir()
    _write(source / "a.txt", b"a\nb\n")
    vocab = spark.createDataFrame([("a", 1)], "token string, id int")
    calls = []

    def ask(fail=False, options=None, vocab=vocab):
        def make():
            calls.append(1)
            df = spark.read.text(str(source)).withColumn("split", F.lit("s"))
            return df.where(F.raise_error(F.lit("broken off")).cast("boolean")) if fail else df

        df, found = keep_encoded(spark, kept, make, [str(source)], [vocab], options or {"max": 4})
        return df.count(), found

    assert ask() == (2, False) and ask() == (2, True) and len(calls) == 1
    assert ask(options={"max": 5}) == (2, False)
    assert ask(vocab=spark.createDataFrame([("a", 2)], "token string, id int")) == (2, False)
    assert ask(vocab=spark.createDataFrame([("a", 1)], "token string, id int").repartition(3)) == (2, True)
    _write(source / "b.txt", b"c\n")
    with pytest.raises(Exception, match="broken off"):
        ask(fail=True)
    assert ask() == (3, False) and ask() == (3, True)  # a broken run is never taken


def test_line_keys_of_long_conversations(spark):
    turns = spark.range(3 * 150).select((F.col("id") % 3).alias("conv_id"), F.floor(F.col("id") / 3).cast("int").alias("turn"))
    keys = [r.k for r in turns.select(fx.line_key("conv_id", "turn").alias("k")).collect()]
    assert len(set(keys)) == 450
    ordered = [(r.conv_id, r.turn) for r in turns.orderBy(fx.line_key("conv_id", "turn")).collect()]
    assert ordered == sorted(ordered)
    with pytest.raises(Exception, match="no line key"):
        spark.createDataFrame([(1, 1 << 20)], "conv_id long, turn int").select(fx.line_key("conv_id", "turn")).collect()
