import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from textmill.functions.prefix import hashed_rank, running_total, with_bucket
from textmill.operators import traininglog as L
from textmill.operators.features import batch_plan
from textmill.sources import corpus, layout, metriclog, nested, vocabfile


def test_blank_lines_separate_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n  one \ntwo\n\n\nthree\n \n four\n")
    (tmp_path / "b.txt").write_text("".join(f"line {i}\n" + ("\n" if i % 7 == 0 else "") for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = corpus.read_corpus_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    a = {}
    for r in sorted((r for r in got if r.doc_id.startswith("a")), key=lambda r: r.line_no):
        a.setdefault(r.doc_id, []).append(r.line)
    assert list(a.values()) == [["one", "two"], ["three"], ["four"]]
    b = sorted((r.line_no, r.doc_id, r.line) for r in got if r.doc_id.startswith("b"))
    assert [x[2] for x in b] == [f"line {i}" for i in range(3000)]
    assert len({x[1] for x in b}) == 1 + 2999 // 7 + 1
    whole = corpus.read_corpus_lines(spark, str(tmp_path), blanks_separate_docs=False)
    assert whole.select("doc_id").distinct().count() == 2


def test_pages(spark):
    html = "<html><head><title>t</title></head><body><script>x='<p>'</script><p>One &amp;lt; two</p><br>Three<!-- no -->\n <b>four</b></body></html>"
    df = spark.createDataFrame([(1, html), (2, "<p> </p>")], "k int, html string")
    assert [tuple(r) for r in corpus.clean_pages(df, ["k"]).collect()] == [(1, "One &lt; two\nThree\nfour")]


def test_running_total_and_rank_equal_plain_windows(spark):
    rng = random.Random(1)
    keys = rng.sample(range(-10**6, 10**6), 2000)
    df = spark.createDataFrame([(k, k % 3, rng.randrange(9), rng.random()) for k in keys], "k bigint, g int, v int, u double")
    got = {r.k: r.t for r in running_total(df, "k", F.col("v"), "t", ["g"], bucket_rows=125).collect()}
    rank = {r.k: r.r for r in hashed_rank(df, "u", ["k"], "r", bucket_rows=125).collect()}
    rows = df.collect()
    for g in range(3):
        total = 0
        for r in sorted((r for r in rows if r.g == g), key=lambda r: r.k):
            assert got[r.k] == total
            total += r.v
    assert [rank[r.k] for r in sorted(rows, key=lambda r: r.u)] == list(range(2000))


def test_totals_by_keys_of_any_type(spark):
    """Text, composite and null keys, one group with most rows: plain sums, and buckets that grow with the keys."""
    rng = random.Random(2)
    names = [None, "", "é", "zz"] + [f"n{rng.randrange(10**9)}" for _ in range(60)]
    keys = sorted({(names[rng.randrange(len(names))], rng.randrange(400)) for _ in range(9000)}, key=lambda k: (k[0] is not None, (k[0] or "").encode(), k[1]))
    rows = [(*k, "hot" if rng.random() < 0.9 else "cold", rng.randrange(9)) for k in keys]
    df = spark.createDataFrame(rows, "a string, b int, g string, v int").repartition(5)
    got = {(r.a, r.b): r.t for r in running_total(df, "a", F.col("v"), "t", ["g"], ["b"], bucket_rows=640).collect()}
    total = {"hot": 0, "cold": 0}
    for a, b, g, v in rows:
        assert got[a, b] == total[g]
        total[g] += v
    assert len(got) == len(rows)
    placed = {(r.a, r.b): r._bucket for r in with_bucket(df, ["a", "b"], 640).collect()}
    order = [placed[k] for k in keys]
    assert order == sorted(order) and set(order) == set(range(max(order) + 1)) and len(set(order)) >= 9
    sizes = [order.count(i) for i in set(order)]
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert running_total(df.limit(0), "a", F.col("v"), "t", ["g"], ["b"]).count() == 0
    one = spark.createDataFrame([("x", 1.5)], "k string, v double")
    assert [r.t for r in running_total(one, "k", F.col("v"), "t").collect()] == [0.0]


def test_lines_and_examples_of_documents_with_text_ids(spark):
    rows = [(f"doc-{d}", n) for d in range(30) for n in range(d % 5)]
    lines = spark.createDataFrame(rows, "doc_id string, line_no int").repartition(4)
    got = {(r.doc_id, r.line_no): r.shard for r in layout.shard(lines, 7, "line").collect()}
    assert got == {k: i % 7 for i, k in enumerate(sorted(rows))}
    examples = [(f"doc-{d}", length, e) for d in range(30) for length in (128, 512) for e in range(512 // length * (d % 3))]
    df = spark.createDataFrame(examples, "doc_id string, max_len int, ex int").repartition(4)
    placed = layout.place_examples(df, 6, 2).collect()
    for job in range(2):
        mine = sorted((r.doc_id, r.max_len, r.ex, r.seq) for r in placed if r.job == job)
        assert [m[3] for m in mine] == list(range(len(mine)))
    assert len(placed) == len(examples)


def test_nested_json_and_labels(spark, tmp_path):
    data = {"data": [{"tokens": ["a", "b"], "tags": [0, 1]}, {"tokens": [], "tags": []}]}
    (tmp_path / "t.json").write_text(json.dumps(data, indent=1))
    rows = nested.read_nested_json(spark, str(tmp_path), "data", "tokens array<string>, tags array<int>").collect()
    assert sorted(tuple(map(tuple, r)) for r in rows) == [((), ()), (("a", "b"), (0, 1))]
    labels = nested.label_map(spark.createDataFrame([(["O", "B-A"],)], "label_list array<string>"))
    assert [tuple(r) for r in labels.orderBy("id").collect()] == [(0, "O"), (1, "B-A")]


def test_nest_and_flatten_are_opposite(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a_x int, a_y_z int, b_x int, c int")
    deep = nested.nest_columns(df, ["a", "b"])
    assert deep.columns == ["c", "a", "b"] and deep.first().a.y_z == 2
    assert sorted(nested.flatten_columns(deep).columns) == sorted(df.columns)


def test_vocab_file_round_trip(spark, tmp_path, caplog):
    vocab = spark.createDataFrame([("b", 1), ("a", 0), ("##c", 2)], "token string, id int")
    vocabfile.write_vocab(vocab, str(tmp_path / "v"))
    assert {tuple(r) for r in vocabfile.read_vocab(spark, str(tmp_path / "v")).collect()} == {("a", 0), ("b", 1), ("##c", 2)}
    assert not caplog.records
    vocabfile.write_vocab(vocab.filter("id <> 1"), str(tmp_path / "w"))
    assert "not consecutive" in caplog.text


def test_examples_go_to_their_files(spark, tmp_path):
    df = spark.createDataFrame([(d, e) for d in range(40) for e in range(d % 4 + 1)], "doc_id bigint, ex int")
    rows = layout.place_examples(df, 10, 3).collect()
    for job in range(3):
        mine = sorted((r.doc_id, r.ex, r.seq, r.out_file) for r in rows if r.job == job)
        files = [i for i in range(10) if i % 3 == job]
        assert [m[2] for m in mine] == list(range(len(mine)))
        assert [m[3] for m in mine] == [files[k % len(files)] for k in range(len(mine))]
    layout.write_examples(df, str(tmp_path / "out"), 10, 3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == df.count()


def test_batches_are_full_but_the_last(spark):
    sizes = {r.batch: r["count"] for r in batch_plan(spark.range(70).toDF("id"), ["id"], 16).groupBy("batch").count().collect()}
    assert sizes == {0: 16, 1: 16, 2: 16, 3: 16, 4: 6}


def test_rank_logs(spark, tmp_path):
    def write(rank, records):
        (tmp_path / f"rank{rank}.log").write_text("".join("DLLL " + json.dumps(r) + "\n" for r in records))

    head = {"type": "META", "step": "PARAMETER", "data": {"lr": 1.0}}
    step = lambda n, v: {"type": "LOG", "step": n, "data": {"loss": v}}
    write(0, [head, step(10, 1.0), step(20, 2.0), step(30, 5.0)])
    write(1, [{**head, "data": {"lr": 9.0}}, step(10, 3.0), step(21, 2.0)])
    log = metriclog.read_metric_logs(spark, str(tmp_path)).withColumn("rank", F.substring("file", 5, 1).cast("int"))
    got = {r.line_no: (r.value, r.status) for r in L.merge_rank_logs(log, 2).collect()}
    assert got == {0: (1.0, "merged"), 1: (2.0, "merged"), 2: (2.0, "step differs"), 3: (5.0, "unmatched")}


def test_step_times_cross_blocks(spark):
    start = datetime(2024, 1, 1)
    rows = [(0, s, start + timedelta(seconds=s * s)) for s in range(1, 30)]
    df = spark.createDataFrame(rows, "rank int, step int, ts timestamp")
    got = {r.step: r for r in L.throughput_eta(df, 8, 2, 100, block=4).collect()}
    assert got[1].seconds is None and all(got[s].seconds == 2 * s - 1 for s in range(2, 30))
    assert got[5].eta == (25 - 1) / 4 * 95 and got[3].per_second == 16 / 5


def test_metric_records_of_mixed_kinds(spark):
    lines = [
        'DLLL {"type":"LOG","step":"PARAMETER","data":{"lr":0.1,"name":"x","deep":{"a":[1,2]},"on":true,"none":null,"big":12345678901}}',
        'DLLL {"type":"LOG","step":10,"data":{"loss":2}}', "DLLL not json", 'DLLL {"type":"META"}',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "k int, line string")
    got = {r.k: r for r in metriclog.parse_metric_lines(df).collect()}
    assert got[0].data == {"lr": 0.1, "none": None, "big": 12345678901.0}
    assert got[0].texts == {"name": "x", "deep": '{"a":[1,2]}', "on": "true"} and got[0].step == "PARAMETER"
    assert got[1].step == "10" and got[1].data == {"loss": 2.0} and got[1].texts == {}
    assert got[2].type is None and got[2].data is None and got[3].type == "META" and got[3].data is None
