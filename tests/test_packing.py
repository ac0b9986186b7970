import random

import pytest
from pyspark.sql import functions as F

from textmill.operators import corrupt as C, packing as P
from textmill.operators.longpacking import pack_long
from textmill.operators.traininglog import metric_windows
from textmill.streaming.idle import run_until_idle
from textmill.streaming.packing import pack_lines_stream, target
from textmill.streaming.traininglog import metric_windows_stream


def corpus():
    rng = random.Random(5)
    docs = {0: [], 1: [(0, [9, 9])], 2: [(0, list(range(5, 300)))], 3: [(0, []), (4, [7])], 4: [(2, [])]}
    for d in range(5, 30):
        docs[d] = [(i, [rng.randrange(5, 99) for _ in range(rng.randrange(0, 30))]) for i in range(rng.randrange(1, 400))]
    docs[30] = [(i, list(range(5, 25))) for i in range(600)]
    return docs


def as_table(spark, docs):
    rows = [(d, no, ids) for d, lines in docs.items() for no, ids in lines]
    return spark.createDataFrame(rows, "doc_id bigint, line_no int, ids array<int>").repartition(5)


def test_lines_are_packed_whole_in_order_up_to_the_target(spark):
    docs = corpus()
    packed = {}
    for r in P.pack_lines(P.documents_of_lines(as_table(spark, docs)), [16, 128]).collect():
        packed.setdefault((r.doc_id, r.max_len), []).append((r.ex, r.target, [(x.line_no, x.ids) for x in r.lines]))
    for d, lines in docs.items():
        for length in (16, 128):
            found = sorted(packed.get((d, length), []))
            assert [ex for ex, *_ in found] == list(range(len(found)))
            joined = [line for *_, some in found for line in some]
            assert joined == lines[: len(joined)] and not any(ids for _, ids in lines[len(joined) :])
            at = 0
            for ex, goal, some in found:
                size = sum(len(ids) for _, ids in some)
                assert goal == target(0, d, length, at) and 5 <= goal <= length
                assert size - len(some[-1][1]) < goal and (size >= goal or ex == len(found) - 1)
                at += len(some)
    assert any(len(v) > P.CHUNK for v in packed.values())
    short = sum(goal < length for (_, length), v in packed.items() for _, goal, _ in v)
    assert 0.02 < short / sum(map(len, packed.values())) < 0.09


@pytest.mark.parametrize("block,tokens", [(1 << 16, 1 << 12), (16, 64), (3, 7)])
def test_long_documents_are_packed_by_pointers_as_by_rows(spark, block, tokens):
    docs = {d: lines for d, lines in corpus().items() if d % 3 == 0 or d < 5}
    docs[31] = [(2 * i, [7] * (i % 3 == 0)) for i in range(700)]  # many lines without tokens
    encoded = as_table(spark, docs)
    got = pack_long(encoded, [16, 128], block=block, tokens=tokens).collect()
    want = P.pack_lines(P.documents_of_lines(encoded), [16, 128]).collect()
    rows = lambda rs: sorted((r.doc_id, r.max_len, r.ex, r.target, [(x.line_no, x.ids) for x in r.lines]) for r in rs)
    assert rows(got) == rows(want)


def test_segments_share_the_lines_and_examples_have_their_form(spark):
    packed = P.pack_lines(P.documents_of_lines(as_table(spark, corpus())), [16, 128])
    both = P.split_segments(packed).join(packed.select("doc_id", "max_len", "ex", "target", "lines"), ["doc_id", "max_len", "ex"])
    built = {(r.doc_id, r.max_len, r.ex): r for r in P.assemble(P.split_segments(packed), F.lit(1), F.lit(2)).collect()}
    singles = rows = 0
    for r in both.collect():
        a, b, goal = list(r.a), list(r.b), (r.target - 3) // 2
        for line in r.lines:  # each line goes whole to the front of what is left of one segment
            n = len(line.ids)
            if a[:n] == line.ids and (len(r.a) - len(a) + n <= len(r.a)) and not (b[:n] == line.ids and len(r.a) - len(a) >= goal):
                a = a[n:]
            else:
                assert b[:n] == line.ids
                b = b[n:]
        assert sorted(r.a + r.b) == sorted(x for line in r.lines for x in line.ids) and (r.a or not r.b)
        singles += not r.b and len(r.lines) > 6
        rows += len(r.lines) > 6
        row = built[r.doc_id, r.max_len, r.ex]
        first = r.a[: r.max_len - 2]
        second = r.b[: max(0, r.max_len - len(first) - 3)]
        ids = [1, *first, 2, *second, *([2] if second else [])]
        rest = r.max_len - len(ids)
        assert rest >= 0 and row.input_ids == ids + [0] * rest and row.input_mask == [1] * len(ids) + [0] * rest
        assert row.segment_ids == [0] * (len(first) + 2) + [1] * (len(ids) - len(first) - 2) + [0] * rest
    assert 0.03 < singles / rows < 0.25


def test_examples_worked_by_hand(spark):
    docs = {1: [(0, [9, 9])], 2: [(0, list(range(5, 300)))], 3: [(0, []), (4, [7])], 4: [(2, [])]}
    rows = P.assemble(P.split_segments(P.pack_lines(P.documents_of_lines(as_table(spark, docs)), [16])), F.lit(1), F.lit(2)).collect()
    assert {r.doc_id: r.input_ids for r in rows} == {
        1: [1, 9, 9, 2] + [0] * 12, 2: [1, *range(5, 19), 2], 3: [1, 7, 2] + [0] * 13,
    }


STREAM = "doc_id bigint, i int, line_no int, ids array<int>, is_last boolean"


def stream_rows(docs):
    return [(d, i, no, ids, i == len(lines) - 1) for d, lines in docs.items() for i, (no, ids) in enumerate(lines)]


def run_stream(spark, folder, idle_ms, quiet_s):
    stream = spark.readStream.schema(STREAM).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    job = (
        pack_lines_stream(stream, 16, idle_ms=idle_ms).writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/state").trigger(processingTime="100 milliseconds").start()
    )
    run_until_idle(job, quiet_s, 300)


def packed_rows(df):
    return sorted((r.doc_id, r.ex, r.target, [(x.line_no, list(x.ids)) for x in r.lines]) for r in df.collect())


def test_stream_equals_batch_out_of_order_repeated_and_after_a_restart(spark, tmp_path):
    docs = {d: lines for d, lines in corpus().items() if lines and d in (1, 2, 3, 4, 6, 9, 30)}
    rows = stream_rows(docs)
    random.Random(3).shuffle(rows)
    for part in range(4):
        again = rows[::9] if part == 3 else []  # lines that come twice, some after their document is done
        spark.createDataFrame(rows[part::4] + again, STREAM).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if part in (1, 3):  # the second run goes on from the first one's checkpoint
            run_stream(spark, tmp_path, idle_ms=600_000, quiet_s=5)
    batch = P.pack_lines(P.documents_of_lines(as_table(spark, docs)), [16])
    assert packed_rows(spark.read.parquet(f"{tmp_path}/out")) == packed_rows(batch)


def test_stream_lets_go_of_documents_without_an_end(spark, tmp_path):
    lines = [(i, [10 + i] * 3) for i in range(4)]
    rows = [r[:4] + (False,) for r in stream_rows({1: lines})]
    rows += [r for r in stream_rows({2: lines}) if r[1] != 1]  # a line that never comes
    spark.createDataFrame(rows, STREAM).coalesce(1).write.parquet(f"{tmp_path}/in")
    run_stream(spark, tmp_path, idle_ms=2000, quiet_s=6)
    got = packed_rows(spark.read.parquet(f"{tmp_path}/out"))
    assert [line for d, _, _, some in got for line in some if d == 1] == lines
    assert [line for d, _, _, some in got for line in some if d == 2] == [lines[0], *lines[2:]]


def test_step_windows_of_a_stream(spark, tmp_path):
    schema = "rank bigint, metric string, step bigint, value double"
    log = [(r, m, s, float(s % 7)) for r in (0, 1) for m in ("loss", "x_accuracy") for s in range(1, 48)]
    late = [(0, "loss", 5, 100.0), (0, "loss", 47, None)]
    for part in ([r for r in log if r[2] <= 25], [r for r in log if r[2] > 25], late):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    job = (
        metric_windows_stream(stream, idle_ms=2000).writeStream.format("parquet").option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/state").trigger(processingTime="100 milliseconds").start()
    )
    run_until_idle(job, 6, 300)
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    batch = metric_windows(spark.createDataFrame(log, schema)).collect()
    on_time = sorted((r.rank, r.metric, r.step, round(r.value, 9)) for r in got if not r.late)
    assert on_time == sorted((r.rank, r.metric, r.step, round(r.value, 9)) for r in batch)
    assert [(r.rank, r.metric, r.step, r.value, r.n) for r in got if r.late] == [(0, "loss", 10, 100.0, 1)]


def examples(spark, seed=1, n=30, length=64):
    rng = random.Random(seed)
    rows = []
    for d in range(n):
        size = rng.randrange(1, length - 2)
        ids = [1] + [rng.randrange(5, 50) for _ in range(size)] + [2]
        fill = [0] * (length - len(ids))
        rows.append((d, length, 0, ids + fill, [1] * len(ids) + fill, [0] * length))
    return spark.createDataFrame(
        rows, "doc_id bigint, max_len int, ex int, input_ids array<int>, input_mask array<int>, segment_ids array<int>")


def test_budget_rounds_half_to_even(spark):
    df = spark.createDataFrame([(n,) for n in (2, 3, 10, 30, 128, 512)], "n int")
    got = {r.n: r.b for r in df.select("n", C.mask_budget(F.col("n"), F.lit(79)).alias("b")).collect()}
    assert got == {2: 1, 3: 1, 10: 2, 30: 4, 128: 19, 512: 77}
    slots = spark.range(1).select(C.max_predictions(128), C.max_predictions(512)).first()
    assert tuple(slots) == (19, 79)


def test_masking_properties(spark):
    ignore = [F.lit(i) for i in (1, 2, 4)]
    candidates = C.mask_candidates(examples(spark), ignore)
    for seed in (0, 1):
        masked = C.apply_mask(C.sample_positions(candidates, seed=seed), F.lit(4), seed)
        restored = C.unmask(masked)
        fakes = C.replace_tokens(restored, F.lit(50), seed, never_right=True)
        for r in fakes.collect():
            assert len(r.positions) == min(r.budget, len(r.candidates)) and len(set(r.positions)) == len(r.positions)
            assert r.restored_ids == r.input_ids
            assert all(r.input_ids[p] not in (1, 2, 4) and r.input_mask[p] == 1 for p in r.positions)
            changed = {i for i, (x, y) in enumerate(zip(r.input_ids, r.masked_ids)) if x != y}
            assert changed <= set(r.positions) and all(r.masked_ids[i] == 4 for i in changed)
            assert {i for i, f in enumerate(r.is_fake) if f} == set(r.positions)
            assert all((x != y) == bool(f) for x, y, f in zip(r.input_ids, r.corrupted_ids, r.is_fake))
    slots = C.masked_slots(masked).first()
    assert len(slots.masked_lm_positions) == len(slots.masked_lm_weights) == len(slots.masked_lm_ids)
    assert sum(slots.masked_lm_weights) == len(slots.positions)


def test_weights_and_replacement(spark):
    weighted = C.mask_candidates(examples(spark), [F.lit(1), F.lit(2)]).withColumn(
        "w", F.transform("input_ids", lambda _, i: F.when(i % 2 == 0, 1.0).otherwise(0.0)))
    for r in C.sample_positions(weighted, weights="w", replacement=True).collect():
        if any(p % 2 == 0 for p in r.candidates):
            assert len(r.positions) == r.budget and all(p % 2 == 0 for p in r.positions)
    barred = examples(spark).withColumn("no", F.transform("input_ids", lambda _, i: i < 3))
    for r in C.mask_candidates(barred, [F.lit(1), F.lit(2)], disallow="no").collect():
        assert all(p >= 3 for p in r.candidates)


def test_scatter_ignores_first_and_averages_duplicates(spark):
    df = spark.createDataFrame([([9, 9, 9, 9], [0, 2, 2, 3], [5, 4, 7, 1])], "s array<int>, p array<int>, u array<int>")
    row = C.scatter_update(df, "s", "p", "u", "out", "hit").first()
    assert row.out == [9, 9, 5, 1] and row.hit == [0, 0, 1, 1]


def test_preview_stops_at_padding(spark):
    vocab = spark.createDataFrame([("[PAD]", 0), ("[CLS]", 1), ("[MASK]", 4), ("x", 5), ("y", 6)], "token string, id int")
    df = spark.createDataFrame([(1, [1, 4, 6, 0, 0], [1], [5])], "k int, masked_ids array<int>, positions array<int>, masked_lm_ids array<int>")
    assert C.preview_masked(df, vocab, ["k"]).first().preview == "[CLS] [MASK] (x) y"


def test_the_state_is_asked_a_few_times_a_key_not_once_a_line(spark):
    """Both streams on a store that counts its calls: many lines out of order, and many windows in a batch."""
    from collections import Counter
    from types import SimpleNamespace

    from textmill.streaming.packing import LinePacker
    from textmill.streaming.traininglog import StepWindows

    calls = Counter()

    class Store:
        def __init__(self):
            self.value, self.map = None, {}

        def __getattr__(self, name):
            calls[name] += 1
            return {
                "get": lambda: self.value, "exists": lambda: self.value is not None, "update": lambda v: setattr(self, "value", v),
                "put": lambda v: setattr(self, "value", list(v)), "clear": lambda: (setattr(self, "value", None), self.map.clear()),
                "containsKey": lambda k: k in self.map, "getValue": lambda k: self.map[k], "removeKey": lambda k: self.map.pop(k),
                "updateValue": lambda k, v: self.map.__setitem__(k, v), "keys": lambda: iter(list(self.map)),
                "iterator": lambda: iter(list(self.map.items())),
            }[name]

    def handle():
        return SimpleNamespace(
            getValueState=lambda *a: Store(), getListState=lambda *a: Store(), getMapState=lambda *a: Store(),
            registerTimer=lambda t: None, deleteTimer=lambda t: None)

    now = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: 5)
    packer = LinePacker(16, 0, 1000, 1000)
    packer.init(handle())
    lines = [SimpleNamespace(i=i, line_no=2 * i, ids=[7] * (i % 5), is_last=i == 2999) for i in range(3000)]
    out = [r for part in (2, 1, 0) for r in packer.handleInputRows((4,), lines[part::3], now)]
    assert [(x.line_no, x.ids) for r in out for x in r.lines][:2990] == [(x.line_no, x.ids) for x in lines][:2990]
    assert sum(calls.values()) < 3000 // 8
    calls.clear()
    windows = StepWindows(10, 0, 1000)
    windows.init(handle())
    rows = [SimpleNamespace(step=s, value=1.0) for s in range(1, 5006)]
    got = [*windows.handleInputRows((1, "loss"), rows[:2503], now), *windows.handleInputRows((1, "loss"), rows[2503:], now)]
    assert [(r.step, r.n, r.late) for r in got] == [(10 * k, 10, False) for k in range(1, 501)]
    assert sum(calls.values()) < 40


def test_blocks_are_crossed_many_at_once_whatever_the_batches():
    import pyarrow as pa

    from textmill.operators import longpacking as L

    draw, rows, crossed, begun = random.Random(3), [], [], []
    for doc in range(30):
        for block in range(3):
            size, first = draw.randint(1, 9), block * 9
            ahead = [first + i + draw.randint(1, 4) if draw.random() < 0.9 else None for i in range(size)]
            entry = draw.randrange(size) if draw.random() < 0.8 else None
            for i, to in enumerate(ahead):
                rows.append((doc, 128, block, first + i, to, 100 + i, 7 if i == entry else None))
                at, hops = i, 1
                while ahead[at] is not None and ahead[at] - first < size:
                    at, hops = ahead[at] - first, hops + 1
                crossed.append((doc, 128, first + i, ahead[at], hops))
            at, ex = entry, 7
            while at is not None:
                begun.append((doc, 128, first + at, ex, 100 + at))
                at, ex = (ahead[at] - first if ahead[at] is not None and ahead[at] - first < size else None), ex + 1
    names = [*L.KEYS, "_block", "pos", "next", "target", "ex"]
    table = pa.table([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)
    listed = lambda made: [tuple(r.values()) for b in made for r in b.to_pylist()]
    for size, enough in ((1, 1), (7, 20), (1000, 1 << 17)):
        L.ROWS, kept = enough, L.ROWS
        try:
            batches = table.to_batches(max_chunksize=size)
            assert listed(L._crossings(iter(batches))) == crossed
            assert sorted(listed(L._starts(iter(batches)))) == sorted(begun)
        finally:
            L.ROWS = kept


def test_draws_of_whole_lists_are_those_of_single_numbers(spark):
    from textmill.functions.drawn import least_drawn, uniform_each
    from textmill.functions.draws import uniform

    draw = random.Random(2)
    rows = [(f"k{'é' * draw.randint(0, 40)}", d, [draw.choice([0, 9, 10, 127, 5000, 2**31 - 1, -3]) for _ in range(d % 7)]) for d in range(300)]
    df = spark.createDataFrame([*rows, (None, 1, [3, 4]), ("n", 2, None)], "name string, d bigint, l array<int>")
    single = F.transform("l", lambda n: uniform(1, "t", "name", "d", n))
    both = df.select(uniform_each(1, "t", "name", "d", numbers="l").alias("a"), single.alias("b")).collect()
    assert [r.a for r in both] == [r.b for r in both]
    ranked = F.sort_array(F.transform("p", lambda n: F.struct(uniform(1, "t", "name", "d", n).alias("k"), n.alias("n"))))
    least = F.sort_array(F.transform(F.slice(ranked, F.lit(1), F.col("m")), lambda x: x["n"]))
    df = df.withColumn("p", F.array_distinct(F.filter("l", lambda n: n >= 0))).withColumn("m", F.pmod("d", F.lit(5)).cast("int"))
    both = df.select(least_drawn(1, "t", "name", "d", numbers="p", n=F.col("m")).alias("a"), least.alias("b")).collect()
    assert [r.a for r in both] == [r.b for r in both]


def test_masking_makes_its_draws_in_batches(spark, capsys):
    """A draw for each place by an expression of its own took most of the time of masking."""
    from textmill.plans import registry

    registry.queries()["replace_tokens_never_right"](spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert plan.count("ArrowEvalPython") > 1 and "md5" not in plan.split("ArrowEvalPython")[0]


class KeyStore:
    """A state store in memory that counts its calls."""

    def __init__(self):
        from collections import Counter

        self.calls, self.values, self.timers, self.now = Counter(), {}, set(), 5

    def getValueState(self, name, *a):
        return KeyStore.State(self, name)

    getMapState = getValueState

    def registerTimer(self, due):
        self.calls["timer"] += 1
        self.timers.add(due)

    def deleteTimer(self, due):
        self.timers.remove(due)

    def getCurrentProcessingTimeInMs(self):
        return self.now

    class State:
        def __init__(self, store, name):
            self.store, self.name = store, name

        def get(self):
            self.store.calls["get"] += 1
            return self.store.values.get(self.name)

        def update(self, value):
            self.store.calls["update"] += 1
            self.store.values[self.name] = value

        def clear(self):
            self.store.values.pop(self.name, None)

        def getValue(self, key):
            return self.store.values[self.name, key]

        def updateValue(self, key, value):
            self.store.values[self.name, key] = value

        def removeKey(self, key):
            del self.store.values[self.name, key]


def bucket(store, idle_ms=1000, keep_ms=10_000):
    """(give, fire) for a bucket: give lines (doc, i, line_no, ids, is_last), or let its timer run out at a time."""
    from types import SimpleNamespace

    import pyarrow as pa

    from textmill.streaming import packing as S

    packer = S.BucketPacker(16, 0, idle_ms, keep_ms)
    packer.init(store)
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int32()))

    def shown(rows):
        rows = [r.asDict() for r in rows]
        packed = S._as_lines(*[pa.array([r[c] for r in rows], pa.binary()) for c in ("numbers", "ends", "ids")]).to_pylist()
        return [(r["doc_id"], r["ex"], [(x["line_no"], x["ids"]) for x in lines]) for r, lines in zip(rows, packed, strict=True)]

    def give(lines, now):
        store.now = now
        columns = [pa.array([line[k] for line in lines], kind) for k, kind in zip((0, 1, 2, 4, 3), kinds, strict=True)]
        return shown(packer.handleInputRows((7,), [(x,) for x in S._as_record(*columns).to_pylist()], store))

    def fire(now):
        out, store.now = [], now
        while due := min((t for t in store.timers if t <= now), default=None):  # one may set the next
            store.timers.remove(due)
            out += packer.handleExpiredTimer((7,), store, SimpleNamespace(getExpiryTimeInMs=lambda due=due: due))
        return shown(out)

    return give, fire


def test_a_bucket_asks_the_store_once_for_all_its_documents():
    store = KeyStore()
    give, _ = bucket(store)
    docs = {d: [(i, [d, i, 9][: (d + i) % 4]) for i in range(9)] for d in range(40)}
    rows = [(d, i, no, ids, i == 8) for d, lines in docs.items() for i, (no, ids) in enumerate(lines)]
    random.Random(1).shuffle(rows)
    out = [r for part in range(4) for r in give(rows[part::4], 5)]
    for d, lines in docs.items():
        got = [line for doc, _, some in sorted(out, key=lambda r: r[:2]) for line in some if doc == d]
        assert got == lines[: len(got)] and sum(len(ids) for _, ids in got) == sum(len(ids) for _, ids in lines)
    assert sum(store.calls.values()) < 16  # once for each document, batch and kind of state before


def test_documents_of_a_bucket_end_and_are_forgotten_in_their_own_time():
    store = KeyStore()
    give, fire = bucket(store)
    assert give([(1, 0, 0, [5], False), (2, 0, 0, [6], False), (2, 2, 2, None, False)], 100) == []
    assert give([(1, 1, 1, [7, None, 65_535, 70_000, -3], False)], 900) == [] and fire(1099) == []
    assert fire(1100) == [(2, 0, [(0, [6]), (2, [])])] and fire(1899) == []
    assert fire(1900) == [(1, 0, [(0, [5]), (1, [7, None, 65_535, 70_000, -3])])]
    assert give([(1, 0, 0, [5], True), (2, 0, 0, [6], True)], 11_050) == []  # sent again
    assert give([(None, 0, None, [3], True), (2, 0, 0, [6], True)], 11_150) == [(None, 0, [(None, [3])]), (2, 0, [(0, [6])])]
    fire(30_000)
    assert store.values == {} and not store.timers


def test_waiting_lines_of_a_long_document_lie_apart(monkeypatch):
    from textmill.streaming import packing as S

    monkeypatch.setattr(S, "NEAR", 2000)
    store = KeyStore()
    give, fire = bucket(store)
    lines = [(1, i, i, [i] * 3, i == 499) for i in range(500)]
    assert give(lines[1:300], 5) == [] and sum(isinstance(k, tuple) for k in store.values) == 5
    assert len(store.values["documents"][1]) < 500
    out = give(lines[:1], 6) + give(lines[400:], 7) + give(lines[300:400], 8)
    assert [line for _, _, some in out for line in some] == [(i, [i] * 3) for i in range(500)]
    assert [k for k in store.values if isinstance(k, tuple)] == []
    assert give([(2, i, i, [i] * 3, False) for i in range(1, 300)], 9) == []
    out = fire(1009)
    assert [line for _, _, some in out for line in some] == [(i, [i] * 3) for i in range(1, 300)]
    assert [k for k in store.values if isinstance(k, tuple)] == []


def test_shuffle_files_go_once_a_table_is_written(spark):
    """They stayed until the driver happened to collect its garbage."""
    import time

    from textmill.functions.stage import materialize

    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses
    materialize(spark.range(1000), "first")
    before = tracker().size()
    for _ in range(3):
        materialize(spark.range(1000).repartition(3), "shuffled")
    for _ in range(100):
        if tracker().size() <= before:
            break
        time.sleep(0.1)
    assert tracker().size() <= before
