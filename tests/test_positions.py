import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from textlab.operators import positions as pos


def test_positional_index_matches_row_number(spark):
    rnd = random.Random(7)
    keys = rnd.sample(range(10 ** 9), 5000)
    df = spark.createDataFrame([(k, k % 3) for k in keys], "k long, g int")
    got = pos.positional_index(df, ["k"], ["g"], out="idx", n_cells=17)
    ref = df.withColumn("ref", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    bad = got.join(ref, ["k", "g"]).where(F.col("idx") != F.col("ref")).count()
    assert bad == 0 and got.count() == 5000


def _splits(spark, n, mode="parity"):
    df = spark.range(n).withColumnRenamed("id", "k")
    rows = pos.split_fraction(df, "k", 90.0, mode).collect()
    tr = {r.k for r in rows if r.split == "train"}
    va = {r.k for r in rows if r.split == "validation"}
    return tr, va


def test_split_gap_9245(spark):
    tr, va = _splits(spark, 9245)
    assert len(tr) == 8320 and min(va) == 8321
    assert 8320 not in tr and 8320 not in va


def test_split_overlap_9255(spark):
    tr, va = _splits(spark, 9255)
    assert len(tr) == 8330 and min(va) == 8329
    assert 8329 in tr and 8329 in va


def test_split_complement(spark):
    tr, va = _splits(spark, 9245, "complement")
    assert tr.isdisjoint(va) and len(tr) + len(va) == 9245


def test_split_tail(spark):
    df = spark.range(1200).withColumnRenamed("id", "k")
    head, tail = pos.split_tail(df, "k", 500)
    assert tail.count() == 500 and head.count() == 700
    assert head.agg(F.max("k")).first()[0] == 699


def test_shuffled_batches_permutation_and_export(spark):
    import os
    import tempfile
    from textlab.operators import batching as bt
    df = spark.range(50).withColumnRenamed("id", "doc_id")
    b = bt.shuffled_batches(df, "doc_id", [0, 1], [0], batch_size=8)
    rows = b.collect()
    for s in (0, 1):
        pos_ = sorted(r.position for r in rows if r.seed == s)
        assert pos_ == list(range(50))
        assert max(r.batch_id for r in rows if r.seed == s) == 6      # short last batch kept
    order0 = [r.doc_id for r in sorted((r for r in rows if r.seed == 0), key=lambda r: r.position)]
    order1 = [r.doc_id for r in sorted((r for r in rows if r.seed == 1), key=lambda r: r.position)]
    assert order0 != order1 and sorted(order0) == list(range(50))
    out = os.path.join(tempfile.mkdtemp(prefix="textlab-batches-", dir="/tmp"), "b")
    bt.write_batches(b, out, n_shards=2)
    back = spark.read.parquet(out)
    assert back.count() == 100 and set(os.listdir(out)) >= {"seed=0", "seed=1"}


def test_null_keys_and_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(None, "a", 1), (3, "a", 2), (1, None, 3), (2, None, 4), (5, "a", 5)],
                               "k long, g string, i int")
    got = {r.i: r.idx for r in pos.positional_index(df, ["k"], ["g"], out="idx").collect()}
    assert got == {1: 0, 2: 1, 5: 2, 3: 0, 4: 1}


def test_split_tail_with_equal_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "d"), (3, "d")], "k long, v string")
    for n in (0, 1, 2, 3, 5, 9):
        head, tail = pos.split_tail(df, "k", n)
        assert tail.count() == min(n, 5)
        assert sorted(map(tuple, head.union(tail).collect())) == sorted(map(tuple, df.collect()))
        assert head.columns == df.columns


def _checked(spark, df, order, groups=(), n_cells=16):
    """Positions equal a single window's, and no cell is above twice the mean."""
    cells = pos.OrderedCells(df, order, groups, n_cells)
    sizes = [r["count"] for r in cells.assign().groupBy("_cell").count().collect()]
    n = df.count()
    assert sum(sizes) == n and max(sizes) <= 2 * max(1, -(-n // n_cells))
    got = pos.positional_index(df, order, groups, out="idx", n_cells=n_cells).collect()
    want = df.select("*", (F.row_number().over(Window.partitionBy(*groups).orderBy(*order)) - 1).alias("idx")).collect()
    key = lambda r: tuple((r[c] is not None, r[c]) for c in [*groups, *order]) + (r["idx"],)
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_hot_and_null_leading_keys_are_split(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 7, rnd.randrange(-10 ** 18, 10 ** 18)]), i) for i in range(3000)]
    _checked(spark, spark.createDataFrame(rows, "k long, i long"), ["k", "i"])


def test_string_double_and_date_keys(spark):
    rnd = random.Random(4)
    word = lambda: "shared prefix of some length " + rnd.choice("aÄz") * rnd.randrange(30)
    rows = [(rnd.choice([None, word()]), rnd.choice([None, float("nan"), rnd.gauss(0, 1), 1e300 * rnd.random()]), i)
            for i in range(2000)]
    df = spark.createDataFrame(rows, "s string, f double, i int").withColumn("d", F.expr("date_add(date'2020-01-01', i % 9)"))
    _checked(spark, df, ["s", "i"])
    _checked(spark, df.where("not isnan(f) or f is null"), ["f", "i"])
    _checked(spark, df.withColumn("f", F.when(F.isnan("f"), F.lit(None)).otherwise(F.col("f"))), ["d", "f", "i"])


def test_order_words_of_doubles_and_decimals(spark):
    rnd = random.Random(6)
    values = [0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.0, 2.0, -1.5, 2.0 ** 52, 2.0 ** 63, 1.7976931348623157e308,
              float("inf"), float("-inf"), float("nan")] + [rnd.choice([-1, 1]) * 2.0 ** rnd.uniform(-1074, 1023) for _ in range(500)]
    values += [2.0 ** k for k in range(-1074, 1024, 13)] + [2.0 ** k * (1 - 2 ** -53) for k in range(-1000, 1024, 13)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", pos._double_word(F.col("v")).alias("w"))
    rows = df.orderBy("v").collect()
    words = [r["w"] for r in rows]
    assert words == sorted(words) and len(set(words)) == len(set(map(repr, values)))
    df = spark.createDataFrame([(i, str(rnd.randrange(-10 ** 24, 10 ** 24)) + ".25") for i in range(500)], "i int, s string")
    _checked(spark, df.select("i", F.col("s").cast("decimal(38,5)").alias("x")), ["x", "i"])


def test_copies_of_one_row_are_split_too(spark):
    df = spark.createDataFrame([(1, "x")] * 700 + [(2, "y"), (0, "z")] + [(None, None)] * 500, "k int, s string")
    _checked(spark, df, ["k", "s"])


def test_groups_and_empty_tables(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "a", None, "b"]), rnd.randrange(50), i) for i in range(1500)]
    _checked(spark, spark.createDataFrame(rows, "g string, k int, i int"), ["k", "i"], ["g"])
    none = spark.createDataFrame([], "k long, v string")
    assert pos.positional_index(none, ["k"], out="idx", total="n").columns == ["k", "v", "idx", "n"]
    assert pos.positional_index(none, ["k"], out="idx").count() == 0
    assert all(p.count() == 0 for p in pos.split_tail(none, "k", 3))


def test_split_tail_with_null_keys_at_the_cut(spark):
    df = spark.createDataFrame([(None, i % 3) for i in range(30)] + [(1, 1), (2, 2)], "k int, v int")
    for n in (1, 2, 3, 15, 31, 32):
        head, tail = pos.split_tail(df, "k", n)
        assert tail.count() == n and head.count() == 32 - n
        assert head.where("k is not null").count() == max(0, 2 - n)
