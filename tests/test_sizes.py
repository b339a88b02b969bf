"""What grows with the tables: estimates, tables of rounds, views along the ground, calendars."""

import math
import shutil
from collections import Counter

import __spark_entry__
import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from canopyflow.functions import spectral
from canopyflow.llm import packing
from canopyflow.operators import components, outline
from canopyflow.sources import stores


def bits(df):
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length()


def test_the_estimate_of_a_long_chain_does_not_double_with_each_round(spark):
    n = 400
    links = spark.createDataFrame([(i, j) for i in range(n) for j in (i - 1, i + 1) if 0 <= j < n], "u long, v long")
    low = components.close(links)
    assert bits(low) < 64
    assert {(x.u, x.label) for x in low.collect()} == {(i, 0) for i in range(n)}


def test_the_estimate_of_a_long_ring_stays_small(spark):
    rows = [(r, c, 0) for r in range(40) for c in range(40) if r in (0, 39) or c in (0, 39)]
    got = outline.rings(spark.createDataFrame(rows, "r int, c int, component long"), tile=2)
    assert bits(got) < 400
    assert sorted((x.area, x.sides) for x in got.collect()) == [(-38 * 38.0, 4 * 38), (1600.0, 160)]


def test_tables_of_earlier_rounds_are_dropped(spark):
    links = spark.createDataFrame([(i, j) for i in range(60) for j in (i - 1, i + 1) if 0 <= j < 60], "u long, v long")
    root = spark._jvm.org.apache.hadoop.fs.Path(components._folder(spark))
    count = lambda: len(root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root))
    before = count()
    components.close(links)
    # the links and the last round's labels
    assert count() - before == 2


def test_a_volume_seen_along_the_ground_returns_no_power(spark):
    rows = [(-10.0, math.pi / 2, 0.1), (None, math.pi / 2, 0.1), (-10.0, math.pi / 2, 0.0), (-10.0, math.pi / 2, None), (-10.0, 0.7, math.pi / -2 + 0.7)]
    px = spark.createDataFrame(rows, "db double, theta double, a double")
    for model, want in (("volume", [-math.inf, None, -math.inf, None]), ("surface", None)):
        flat, valid = spectral.slope_correction(F.col("db"), F.col("theta"), F.col("a"), F.lit(0.0), model)
        got = [x.flat for x in px.select(flat.alias("flat"), valid.alias("valid")).collect()]
        assert want is None or got[:4] == want


def same(spark, root, name):
    con = duckdb.connect()
    for f in root.glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}{'/*.parquet' if f.is_dir() else ''}'")
    want = con.sql(__spark_entry__.oracle_sql()[name])
    got = __spark_entry__.queries()[name](spark, str(root)).select(*want.columns)
    return Counter(map(tuple, got.collect())), Counter(want.fetchall())


def test_radar_of_an_area_so_long_that_it_is_seen_along_the_ground(spark, tmp_path):
    shutil.copy("/root/testdata/sf0.001/nation.parquet", tmp_path)
    v = spark.range(1600 * 25, 1630 * 25).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.sin(F.col("id") * 7 + k * k).cast("float")).alias("embedding"))
    v.write.parquet(str(tmp_path / "embeddings.parquet"))
    for name in ("radar_collection", "radar_change"):
        got, want = same(spark, tmp_path, name)
        assert got == want and got


def test_first_drops_are_told_in_the_nearest_millisecond(spark, tmp_path):
    day = "timestamp_ntz'2024-01-{} 00:00:00.{}'"
    rows = [(u, 1, "05", "0", 90.0) for u in (1, 2, 3)] + [(u, 10 + k, 12 + k, part, 10.0) for u, part in ((1, "0004"), (2, "0005"), (3, "000999")) for k in (0, 1)]
    events = " UNION ALL ".join(f"SELECT {u}L AS user_id, {e}L AS event_id, {day.format(d, part)} AS ts, {v}D AS value" for u, e, d, part, v in rows)
    spark.sql(events).write.parquet(str(tmp_path / "events.parquet"))
    got, want = same(spark, tmp_path, "radar_detect")
    assert got == want
    assert sorted(x[4] % 1000 for x in got) == [0, 1, 1]


def test_days_and_releases_are_not_multiplied(spark):
    day = lambda k: F.date_add(F.lit("2000-01-01").cast("date"), k)
    days = spark.range(0, 3000, 7).select(day(F.col("id").cast("int")).alias("target")).unionByName(spark.sql("SELECT cast(NULL AS date) AS target"))
    rel = spark.range(0, 400).select(F.col("id").alias("release"), F.when(F.col("id") % 50 != 0, day((F.col("id") * F.col("id") % 2500 - 300).cast("int"))).alias("captured"))
    got = stores.nearest_release(days, rel)
    # only a null day is joined without a key, with the newest release
    assert got._jdf.queryExecution().executedPlan().toString().count("NestedLoop") + got._jdf.queryExecution().executedPlan().toString().count("Cartesian") == 1
    dated = [x for x in rel.collect() if x.captured]
    newest = max(dated, key=lambda x: (x.captured, -x.release))
    want = {(d.target, *min((abs((d.target - x.captured).days), -x.captured.toordinal(), x.release, x.captured) for x in dated)[:3:2]) for d in days.collect() if d.target}
    assert {(x.target, x.gap, x.release) for x in got.collect() if x.target} == want
    assert [(x.release, x.captured, x.gap) for x in got.where("target is null").collect()] == [(newest.release, newest.captured, None)]
    assert stores.nearest_release(days, rel.limit(0)).count() == 0


def test_what_texts_use_again_is_not_tokenized_again(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    coder = packing.Encoder(packing.tokenizer_path())
    asked, word = Counter(), coder.word
    coder.words.find = lambda w: (asked.update([w]), word(w))[1]
    for k in range(20):
        coder.encode([b"common " + b" ".join(b"w%s" % bytes(97 + int(d) for d in str(k * 40 + i)) for i in range(40))])
    assert asked["common"] == 1 and len(coder.chunks) <= 100


def test_chunks_of_letters_and_signs_are_encoded_as_by_the_tokenizer():
    coder = packing.Encoder(packing.tokenizer_path())
    texts = ["Don't it's 's 'S x's, x', \"quoted\" a.b, END!!! (a) b<c <|endoftext|> a<|endoftext|>, 12a a12 ...'s ~~~' Ünder, straße! ﬁne ét́ İx 中文, 中。 word word " + "Q" * 90 + "!?" * 50, "", "\t a \n"]
    got = [list(memoryview(x).cast("I")) for x in coder.encode([t.encode() for t in texts])]
    assert got == [coder.tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_worker_does_not_keep_what_an_ended_task_remembered(spark):
    texts = spark.range(0, 3_000, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("common"), F.md5(F.col("id").cast("string"))).alias("text"))
    assert packing.token_pieces(texts, packing.tokenizer_path()).count() == 3_000

    def left(batches):
        import pyarrow as pa

        from canopyflow.llm import packing as here

        for _ in batches:
            yield pa.RecordBatch.from_pylist([{"kept": sum(len(t) + len(t.elder) for e in here._ENCODERS.values() for t in (e.chunks, e.words)), "encoders": len(here._ENCODERS)}])

    got = spark.range(0, 8, 1, 8).mapInArrow(left, "kept long, encoders long").collect()
    assert any(r.encoders for r in got) and not any(r.kept for r in got)


def test_a_chunk_that_texts_hold_often_is_looked_up_once_and_not_kept_as_an_object_of_python():
    coder = packing.Encoder(packing.tokenizer_path())
    asked, cut = Counter(), Counter()
    word, chunk = coder.word, coder.chunk
    coder.words.find = lambda w: (asked.update([w]), word(w))[1]
    coder.chunks.find = lambda c: (cut.update([c]), chunk(c))[1]
    texts = ["Common COMMON, common! it's 12 été, | " * 50, "common? ÉTÉ 中文 it's", ""]
    for _ in range(2):
        got = [list(memoryview(x).cast("I")) for x in coder.encode([t.encode() for t in texts])]
        assert got == [coder.tok.encode(t, add_special_tokens=False).ids for t in texts]
    # letters with signs behind them are cut in columns, so chunk() sees the others alone, and nothing at a text's end
    assert set(cut) == {"it's", "12", "|", "中文", ""} and {*cut.values(), *asked.values()} == {1}
    assert set(asked) == {"common", "été", "", ",", "!", "?"}
    names = pa.array([f"w{k}" for k in range(10_000)])
    table = packing.Remembered(lambda w: w.encode() * 2, 64)
    assert table[names].to_pylist() == [f"w{k}w{k}".encode() for k in range(10_000)] == table[names].to_pylist()
    assert len(table) == 10_000 and table.younger.nbytes < 30 * 10_000


def test_texts_are_encoded_alike_however_they_lie_in_batches(spark, monkeypatch):
    words = F.transform(F.sequence(F.lit(1), (F.col("id") * 37 % 90).cast("int")), lambda i: F.concat(F.lit("Wörd"), F.translate(F.md5((F.col("id") * i).cast("string")), "0123456789", "ghijklmnop"), F.lit(",")))
    docs = spark.range(0, 300, 1, 2).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 11 != 0, F.concat_ws(" ", words)).alias("text"))
    tok = packing.Encoder(packing.tokenizer_path()).tok
    want = {r.doc_id: [*tok.encode(r.text or "", add_special_tokens=False).ids, 0] for r in docs.collect()}
    for rows in ("10000", "7"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        try:
            got = {}
            for r in packing.token_pieces(docs, packing.tokenizer_path(), 64, with_ids=True).orderBy("doc_id", "piece").collect():
                got.setdefault(r.doc_id, []).extend(r.ids)
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == want
