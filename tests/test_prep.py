import pytest
from pyspark.sql import functions as F

from lexiflow.operators import prep
from lexiflow.operators.lookup import heavy_items
from lexiflow.sources.fixtures import EOS_ID, PAD_ID, UNK_ID


@pytest.fixture
def vocab(spark):
    return spark.createDataFrame([("a", 4), ("b", 5), ("c", 6), ("d", 7)], "token string, id int")


def _enc(spark, vocab, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id long, text string")
    out = prep.encode(df, {"text": "ids"}, vocab, **kw)
    return {r.row_id: list(r.ids) for r in out.collect()}


def test_encode_unknown_and_specials(spark, vocab):
    got = _enc(spark, vocab, ["a b z", "", "  d  a ", "zz yy"])
    assert got == {0: [0, 4, 5, UNK_ID, EOS_ID], 1: [0, EOS_ID], 2: [0, 7, 4, EOS_ID], 3: [0, UNK_ID, UNK_ID, EOS_ID]}


def test_encode_language_code_prefix(spark, vocab):
    got = _enc(spark, vocab, ["a b"], prefix_ids=(), suffix_ids=(EOS_ID, 250004))
    assert got == {0: [4, 5, EOS_ID, 250004]}


def test_truncate_and_prepend(spark):
    df = spark.createDataFrame([([0, 4, 5, 6, 7, 2],), ([0, 2],), ([0, 4, 2],)], "ids array<int>")
    got = [list(r[0]) for r in prep.truncate_ids(df, "ids", 4).collect()]
    assert got == [[0, 4, 5, 2], [0, 2], [0, 4, 2]]
    tiny = [list(r[0]) for r in prep.truncate_ids(df, "ids", 1).collect()]
    assert tiny == [[0, 2], [0, 2], [0, 2]]  # limit below the special count keeps only specials
    no_bos = spark.createDataFrame([([4, 5, 6, 2],)], "ids array<int>")
    t = prep.truncate_ids(no_bos, "ids", 3, n_prefix=0, n_suffix=1)
    p = prep.prepend_start(t, "ids", bos_id=None, pad_id=PAD_ID)
    assert list(p.first()[0]) == [PAD_ID, 4, 5, 2]  # max + 1 after the start pad


def test_length_filter_inclusive(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], [1]), (2, [1, 2, 3, 4], [1]), (3, [], [1, 2])], "k int, a array<int>, b array<int>")
    kept = [r.k for r in prep.filter_by_length(df, {"a": 3, "b": 2}).collect()]
    assert sorted(kept) == [1, 3]


def test_masks_and_shift_on_padded_rows(spark):
    df = spark.createDataFrame([([0, 4, 2, 1, 1],)], "ids array<int>")
    r = prep.shift_targets(prep.mask_from_pad(df, "ids", "m"), "ids").first()
    assert list(r.m) == [1, 1, 1, 0, 0]
    assert list(r.decoder_ids) == [0, 4, 2, 1] and list(r.labels) == [4, 2, 1, 1]
    b = prep.mask_from_pad(df, "ids", "mb", as_bool=True).first()
    assert list(b.mb) == [True, True, True, False, False]
    e = spark.createDataFrame([([],)], "ids array<int>")
    s = prep.shift_targets(e, "ids").first()
    assert list(s.decoder_ids) == [] and list(s.labels) == []


def test_decode_skips_specials_and_keeps_empty(spark, vocab):
    df = spark.createDataFrame([(0, [0, 4, 3, 5, 2, 1, 1]), (1, [0, 2]), (2, [99, 6])], "row_id long, ids array<int>")
    got = {r.row_id: r.text for r in prep.decode(df, "ids", vocab).collect()}
    assert got == {0: "a b", 1: "", 2: "c"}


def test_roundtrip(spark, vocab):
    df = spark.createDataFrame([(0, " a  b\nc ")], "row_id long, text string")
    enc = prep.encode(df, {"text": "ids"}, vocab)
    assert prep.decode(enc, "ids", vocab).first().text == "a b c"


def test_dataset_size_and_steps(spark):
    df = spark.createDataFrame([("train",)] * 10 + [("validation",)] * 3 + [("test",)] * 2, "split string")
    per = {r.split: r.n_rows for r in prep.dataset_size(df).collect()}
    assert per == {"train": 10, "validation": 3, "test": 2}
    both = prep.dataset_size(df, splits=["train", "validation"]).first().n_rows
    assert both == 13
    steps = spark.range(1).select(prep.run_steps_expr(F.lit(both), epochs=1, devices=1, accum=1, batch_size=4)).first()[0]
    assert steps == pytest.approx(13 / 4)


def test_limits_inside_encode_equal_limits_after(spark, vocab):
    texts = ["a b c d a b", "a", "", "z z z z z z z"]
    df = spark.createDataFrame([(i, t, t[::-1]) for i, t in enumerate(texts)], "row_id long, s string, t string")
    full = prep.encode(df, {"s": "a_ids", "t": "b_ids"}, vocab)
    cut = prep.encode(df, {"s": "a_ids", "t": "b_ids"}, vocab, max_lens={"a_ids": 4})
    exp = {r.row_id: (list(r.a_ids), list(r.b_ids)) for r in prep.truncate_ids(full, "a_ids", 4).collect()}
    assert {r.row_id: (list(r.a_ids), list(r.b_ids)) for r in cut.collect()} == exp
    kept = prep.encode(df, {"s": "a_ids", "t": "b_ids"}, vocab, drop_over={"a_ids": 4, "b_ids": 8})
    exp2 = {r.row_id for r in prep.filter_by_length(full, {"a_ids": 4, "b_ids": 8}).collect()}
    assert {r.row_id for r in kept.collect()} == exp2


def test_rows_that_share_a_key_stay_apart(spark):
    vocab = spark.createDataFrame([("a", 4), ("b", 5)], "token string, id int")
    df = spark.createDataFrame([(1, "a a"), (1, "b"), (1, "b")], "row_id long, text string")
    enc = prep.encode(df, {"text": "ids"}, vocab)
    assert sorted(r.ids for r in enc.collect()) == [[0, 4, 4, 2], [0, 5, 2], [0, 5, 2]]
    assert sorted(r.text for r in prep.decode(enc, "ids", vocab).collect()) == ["a a", "b", "b"]


@pytest.mark.parametrize("head", [0, 1, 100, 10_000])
def test_lookup_is_the_same_whatever_the_head_holds(spark, head):
    vocab = spark.createDataFrame([("a", 4), ("b", 5), ("c", 6)], "token string, id int")
    df = spark.createDataFrame([(1, "a b x", "c"), (2, "", None), (3, "b " * 50 + "x", "y x a"), (None, "c a", "b")], "row_id long, s string, t string")
    enc = prep.encode(df, {"s": "s_ids", "t": "t_ids"}, vocab, head=head, specials={"t_ids": ((), (2, 77))})
    got = {r.row_id: (r.s_ids, r.t_ids) for r in enc.collect()}
    assert got == {1: ([0, 4, 5, 3, 2], [6, 2, 77]), 2: ([0, 2], [2, 77]), 3: ([0, *[5] * 50, 3, 2], [3, 3, 4, 2, 77]), None: ([0, 6, 4, 2], [5, 2, 77])}
    dec = prep.decode_columns(enc, {"s_ids": "s", "t_ids": "t"}, vocab, specials=(0, 2, 3, 77), head=head)
    assert {r.row_id: (r.s, r.t) for r in dec.collect()} == {1: ("a b", "c"), 2: ("", ""), 3: (" ".join(["b"] * 50), "a"), None: ("c a", "b")}


def test_heavy_items_are_the_frequent_ones(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("t"))
    got = [r.t for r in heavy_items(df.repartition(9), "t", head=5, tracked=100).collect()]
    assert "hot" in got and len(got) <= 5


def test_one_plan_and_one_read(spark, tmp_path):
    """The rows are scanned once, and once by the sketch; rare tokens meet the table in a shuffle join."""
    vocab = spark.createDataFrame([("a", 4)], "token string, id int")
    spark.createDataFrame([(1, "a b")], "row_id long, text string").write.parquet(str(tmp_path / "t"))
    plan = prep.encode(spark.read.parquet(str(tmp_path / "t")), {"text": "ids"}, vocab, head=7)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 4 and "Union" not in plan


def test_tokens_do_not_become_rows(spark):
    """With the table in the head rows stay where they are; with a tail each row's different rare tokens are
    the only ones that are dealt."""
    vocab = spark.createDataFrame([("a", 4), ("b", 5)], "token string, id int")
    df = spark.createDataFrame([(1, "a b a")], "row_id long, text string")
    enc = prep.encode(df, {"text": "ids"}, vocab)
    for out in (enc, prep.decode(enc, "ids", vocab)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "Aggregate" not in plan and "Repartition" not in plan
    tail = prep.encode(df, {"text": "ids"}, vocab, head=1)._jdf.queryExecution().optimizedPlan().toString()
    assert tail.count("Generate") == 1 and "array_distinct" in tail and "Aggregate" not in tail


def test_tail_over_many_blocks(spark, monkeypatch):
    """Rare tokens in and out of the table, in few blocks, both ways, whatever the values' type."""
    from lexiflow.operators import lookup

    monkeypatch.setattr(lookup, "BLOCKS", 3)
    words = [f"w{i}" for i in range(300)]
    vocab = spark.createDataFrame([(w, i + 4) for i, w in enumerate(words) if i % 7], "token string, id int")
    texts = [" ".join(["w1"] * (k % 5) + [words[(k * j) % 300] for j in range(k % 11)]) for k in range(120)]
    df = spark.createDataFrame([(k // 2, t) for k, t in enumerate(texts)], "row_id long, s string").repartition(5)
    enc = prep.encode(df, {"s": "ids"}, vocab, head=5)
    ids = {w: i + 4 if i % 7 else 3 for i, w in enumerate(words)}
    assert sorted((r.row_id, r.ids) for r in enc.collect()) == sorted((k // 2, [0, *[ids[w] for w in t.split()], 2]) for k, t in enumerate(texts))
    dec = prep.decode_columns(enc, {"ids": "s"}, vocab, head=5)
    want = sorted((k // 2, " ".join(w for w in t.split() if ids[w] != 3)) for k, t in enumerate(texts))
    assert sorted((r.row_id, r.s) for r in dec.collect()) == want
