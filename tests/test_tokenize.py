import pickle
import random
import unicodedata

import numpy as np
import pyarrow as pa
from conftest import make_vocab
from pyspark.sql import functions as F

from textmill.functions.decompose import decompose
from textmill.functions.text import is_plain, is_plain_run, words_of
from textmill.operators import merges as M, pieces as P, splitting, tokenize as T, vocabulary as V


def words(spark, text, **options):
    return spark.createDataFrame([(text,)], "t string").select(words_of("t", **options)).first()[0]


def test_cleaning_and_splitting(spark):
    assert words(spark, "a+b=$c", lower=False) == ["a", "+", "b", "=", "$", "c"]
    assert words(spark, "x\u0000�​y\tz w", lower=False) == ["xy", "z", "w"]
    assert words(spark, "ab中文cd", lower=False) == ["ab", "中", "文", "cd"]
    assert words(spark, "한국어 テスト", lower=True) == ["한국어", "テスト"]
    assert words(spark, "Été ÉTÉ", lower=True) == ["ete", "ete"]
    assert words(spark, "Été", lower=False) == ["Été"]
    assert words(spark, "éa", lower=True) == ["ea"]
    assert words(spark, "Say [MASK] Now[SEP]", lower=True) == ["say", "[MASK]", "now", "[SEP]"]
    assert words(spark, "say [mask]", lower=True) == ["say", "[", "mask", "]"]
    assert words(spark, "İx", lower=True) == ["ix"]
    assert words(spark, "", lower=True) == []


def greedy(word, vocab, limit=100):
    if len(word) > limit:
        return ["[UNK]"]
    out, at = [], 0
    while at < len(word):
        for end in range(len(word), at, -1):
            piece = ("##" if at else "") + word[at:end]
            if piece in vocab:
                out.append(piece)
                at = end
                break
        else:
            return ["[UNK]"]
    return out


def test_wordpiece_cases(spark):
    tokens = ["un", "##aff", "##able", "a", "##a", "##aa", "b"]
    vocab = make_vocab(spark, tokens)
    given = ["unaffable", "a" * 100, "a" * 101, "unx", "zzz", "b", "aab"]
    df = spark.createDataFrame([(w,) for w in given], "word string")
    got = {r.word: r.pieces for r in T.wordpiece(df, vocab).collect()}
    assert got == {w: greedy(w, set(tokens)) for w in given}
    assert got["unaffable"] == ["un", "##aff", "##able"]
    assert got["a" * 101] == ["[UNK]"]


def test_rows_are_encoded_in_place(spark):
    vocab = make_vocab(spark, ["a", "b", "##b", "c"])
    rows = [(i, ["a", "a bb", "a c bb zz", "", "a a a c", None][i % 6]) for i in range(60)]
    encoded = T.encode_rows(spark.createDataFrame(rows, "k int, text string"), ["k"], "text", vocab)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan and "Window" not in plan
    want = {r.k: r.ids for r in encoded.collect()}
    assert len(want) == 60 and want[3] == want[5] == [] and want[2] == [5, 8, 6, 7, 0] and want[4] == [5, 5, 5, 8]


def test_the_trie_finds_what_a_greedy_loop_finds(spark):
    rng = random.Random(4)
    letters = "abcdé中\U0001f600[(\\.#"
    tokens = sorted({("##" if rng.random() < 0.6 else "") + "".join(rng.choice(letters) for _ in range(rng.randrange(1, 5))) for _ in range(400)})
    tokens += [chr(0x3041 + i) + x for i in range(80) for x in ("", "b")]
    vocab = make_vocab(spark, tokens)
    words_ = ["".join(rng.choice(letters + "\u3041\u3050") for _ in range(rng.randrange(1, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(w,) for w in sorted(set(words_))], "word string")
    known = set(tokens)
    for r in T.wordpiece(df, vocab).collect():
        assert r.pieces == greedy(r.word, known), r.word


def test_added_tokens_pass_whole(spark):
    vocab = make_vocab(spark, ["ab", "cd", "tok", "xx", "##yy"])
    new = spark.createDataFrame([("new tok", 1), ("New", 2)], "token string, o int")
    grown = V.add_tokens(vocab, new, "o", lower=True)
    ids = {r.token: r.id for r in grown.collect()}
    rows = spark.createDataFrame([(1, "ab new tok cd"), (2, "xxNEWtok"), (3, "new  tok"), (4, "[MASK]new")], "k int, text string")
    got = {r.k: r.ids for r in T.encode_rows(rows, ["k"], "text", grown).collect()}
    assert got[1] == [ids["ab"], ids["new tok"], ids["cd"]]
    assert got[2] == [ids["xx"], ids["new"], ids["tok"]] and got[3] == [ids["new"], ids["tok"]]
    assert got[4] == [ids["[MASK]"], ids["new"]]
    cased = {r.k: r.ids for r in T.encode_rows(rows, ["k"], "text", T.Codebook(grown, lower=False)).collect()}
    assert cased[2] == [0]


ODD = [
    "ab中文cd [MASK]", "한국어 テスト", "İstanbul İ", "x\u0000y\u200bz caf\u0301e", "a" * 100 + " " + "a" * 101, "[SEP][sep]",
    "\u3000ab\u00a0cd\u2028x", "", " \t", "\U0001f600ab \U0001f600", "ΑΣ. ΑΣΑ", "\ue000ab\ufffd", "á̂b a",
]


def test_offsets_have_the_ids_of_encoding(spark):
    vocab = make_vocab(spark, ["ab", "cd", "中", "a", "##a", "ist", "##anbul", "i", "x", "##y", "##z", "cafe", "[", "sep", "]", "한", "##국"])
    df = spark.createDataFrame(list(enumerate(ODD)), "k int, text string")
    ids = {r.k: r.ids for r in T.encode_rows(df, ["k"], "text", vocab).collect()}
    found = T.with_offsets(df, "text", "t", vocab).collect()
    for r in found:
        assert [t.id for t in r.t] == ids[r.k], r.text
        assert all(0 <= t.s < t.e <= len(r.text) for t in r.t)
        assert all(x.e <= y.s for x, y in zip(r.t, r.t[1:]))
    spans = {(r.k, t.token): r.text[t.s:t.e] for r in found for t in r.t}
    assert spans[0, "[MASK]"] == "[MASK]" and spans[0, "中"] == "中" and spans[2, "ist"] == "İst"
    assert spans[3, "x"] == "x" and spans[3, "##z"] == "z" and spans[3, "cafe"] == "caf\u0301e"
    assert [t.token for t in found[4].t] == ["a"] + ["##a"] * 99 + ["[UNK]"] and found[4].t[-1].e == 202


def test_offsets_point_into_the_original(spark):
    vocab = make_vocab(spark, ["caf", "##e", "ok", ".", "e"])
    text = "  Café,  ok. zz​ok"
    df = spark.createDataFrame([(1, text)], "k int, text string")
    got = T.token_offsets(df, ["k"], "text", vocab).orderBy("s").collect()
    assert [(r.token, text[r.s:r.e]) for r in got] == [
        ("caf", "Caf"), ("##e", "é"), ("[UNK]", ","), ("ok", "ok"), (".", "."), ("[UNK]", "zz​ok")
    ]
    chars = spark.createDataFrame([(1, 3), (1, 0), (1, 10)], "k int, at int")
    found = {r.at: r.token for r in T.char_to_token(T.token_offsets(df, ["k"], "text", vocab), chars, ["k"], "at").collect()}
    assert found == {3: "caf", 0: None, 10: "ok"}


def test_decode_gives_words_back(spark):
    vocab = make_vocab(spark, ["do", "not", "##n", "'", "t", ".", "it", "s"])
    ids = {r.token: r.id for r in vocab.collect()}
    seq = [ids[t] for t in ["[CLS]", "it", "'", "s", "do", "##n", "'", "t", ".", "[SEP]"]]
    df = spark.createDataFrame([(1, seq)], "k int, ids array<int>")
    assert T.decode(df, ["k"], "ids", vocab).first().text == "it's don't."
    kept = T.decode(df, ["k"], "ids", vocab, skip_special=False, tidy=False).first().text
    assert kept == "[CLS] it ' s don ' t . [SEP]"


def test_added_tokens_win_and_unknown_is_unk(spark):
    vocab = make_vocab(spark, ["a"])
    new = spark.createDataFrame([("B", 2), ("b", 5), ("a", 1), ("c", 0)], "token string, o int")
    grown = V.add_tokens(vocab, new, "o", lower=True)
    assert {r.token: r.id for r in grown.filter("source = 'added'").collect()} == {"c": 6, "b": 7}
    asked = spark.createDataFrame([("b",), ("q",), ("a",)], "token string")
    assert {r.token: r.id for r in T.to_ids(asked, grown).collect()} == {"b": 7, "q": 0, "a": 5}


def merges_by_hand(counts, k):
    words = {w: [c if i == 0 else "##" + c for i, c in enumerate(w)] for w in counts}
    out = []
    for _ in range(k):
        pairs = {}
        for w, s in words.items():
            for p in zip(s, s[1:]):
                pairs[p] = pairs.get(p, 0) + counts[w]
        if not pairs:
            break
        a, b = min(pairs, key=lambda p: (-pairs[p], p))
        token = a + b.removeprefix("##")
        out.append((a, b, token, pairs[(a, b)]))
        for w, s in words.items():
            merged, i = [], 0
            while i < len(s):
                if i + 1 < len(s) and (s[i], s[i + 1]) == (a, b):
                    merged.append(token)
                    i += 2
                else:
                    merged.append(s[i])
                    i += 1
            words[w] = merged
    return out


def test_merges_equal_the_sequential_algorithm(spark, monkeypatch):
    rng = random.Random(8)
    samples = [{"aaaa": 3, "aab": 5, "abab": 4, "banana": 2, "a": 9, "aaaaaaa": 1}]
    for letters in ("ab", "abcd", "abcdefghijkl"):
        words = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(120)}
        samples.append({w: rng.randrange(1, 6) for w in words})
    for counts in samples:
        df = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
        got = [tuple(r)[1:] for r in V.learn_wordpiece(df, merges=70).orderBy("merge_no").collect()]
        assert got == merges_by_hand(counts, 70)
    # A frontier too small for all pairs is filled again and gives the same.
    monkeypatch.setattr(M, "FRONTIER", 6)
    got = [tuple(r)[1:] for r in V.learn_wordpiece(df, merges=25).orderBy("merge_no").collect()]
    assert got == merges_by_hand(counts, 25)


def test_words_are_matched_side_by_side_as_one_by_one(monkeypatch):
    """Against a greedy loop, by the table and by searched edges; nothing is kept of the words."""
    rng = random.Random(20)

    def by_hand(word, heads, tails, whole, most):
        if not word or word in whole:
            return [(whole.get(word, 7), 0, len(word or ""))]
        out, at = [], 0
        while at < len(word) <= most:
            ends = [e for e in range(len(word), at, -1) if word[at:e] in (tails if at else heads)]
            if not ends:
                break
            out.append(((tails if at else heads)[word[at : ends[0]]], at, ends[0] - at))
            at = ends[0]
        return out if at == len(word) else [(7, 0, len(word))]

    for dense in (P.DENSE, 0):
        monkeypatch.setattr(P, "DENSE", dense)
        for letters in ("ab", "abc#", "ab\u00e9\u4e2d\U0001F600"):
            draw = lambda most: "".join(rng.choice(letters) for _ in range(rng.randrange(1, most)))
            heads, tails = ({draw(5): base + i for i in range(25)} for base in (100, 200))
            whole = {"[UNK]": 7, draw(4): 8}
            given = [None, "", "[UNK]", *whole, *letters, "zz", *(draw(n) for n in (3, 9, 40) for _ in range(60))]
            matcher = P.Matcher(heads, tails, whole, 7, "[UNK]", 30)
            size = len(pickle.dumps(matcher))
            coded = P.Coded(matcher, pa.array(["x", *given])[1:])
            got = iter(zip(coded.ids.tolist(), coded.f.tolist(), coded.size.tolist(), strict=True))
            assert [[next(got) for _ in range(n)] for n in coded.n] == [by_hand(w, heads, tails, whole, 30) for w in given]
            assert len(pickle.dumps(matcher)) == size and vars(matcher).keys() <= {*"given heads tails whole unk unk_name max_chars key trie".split()}
    none = P.Matcher({}, {}, {}, 7, "[UNK]", 30)
    assert P.Coded(none, pa.array(["ab", None])).ids.tolist() == [7, 7]
    assert len(P.Coded(none, pa.array([], pa.string())).ids) == 0


def test_characters_of_slices_come_from_the_buffer():
    texts = pa.array(["ab", "", "\u00e9\U0001F600", "c"])
    for part, wanted in ((texts, "ab\u00e9\U0001F600c"), (texts[1:3], "\u00e9\U0001F600"), (texts[:2], "ab"), (texts[4:], "")):
        assert splitting.characters(part).tolist() == list(map(ord, wanted))


def test_plain_texts_have_no_null_beside_them(spark):
    """A list of nulls is gone through again at each row of an Arrow batch. What is plain is told for every character."""
    texts = [("ab c",), ("",), ("\u4e2d",), ("x [MASK]",), (None,)]
    rows = spark.createDataFrame(texts, "t string").select(*T.plain_or_words(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [("ab c", []), ("", []), (None, ["\u4e2d"]), (None, ["x", "[MASK]"]), (None, None)]
    df = spark.createDataFrame([(c, f"a{chr(c)}b\n") for c in range(0x11000) if not 0xD800 <= c < 0xE000], "c int, t string")
    got = {(r.c, r.plain, r.run) for r in df.select("c", is_plain("t").alias("plain"), is_plain_run("t").alias("run")).collect()}
    far = {0x130, *range(0x300, 0x2010), *range(0x2028, 0x11000)}
    dropped = {*range(0x20), *range(0x7F, 0xA0), 0xAD} - {9, 10, 13}
    assert got == {(c, c not in far | dropped, c not in far) for c in range(0x11000) if not 0xD800 <= c < 0xE000}


def test_the_state_of_merges_is_two_bytes_a_symbol_and_a_count_a_word():
    words, n = ["abab", "b", "", "ba\U0001F600"], [3, 2, 1, 5]
    names = [M.END, *sorted({("##" if i else "") + c for w in words for i, c in enumerate(w)})]
    made = list(M._pack(names)(iter([pa.RecordBatch.from_arrays([pa.array(words), pa.array(n, pa.int64())], ["word", "n"])])))
    symbols, counts = (np.frombuffer(made[0].column(i)[0].as_py(), kind) for i, kind in enumerate(["<u2", "<i8"]))
    assert [names[s] for s in symbols] == ["a", "##b", "##a", "##b", "", "b", "", "", "b", "##a", "##\U0001F600", ""]
    assert counts.tolist() == n
    number = {name: i for i, name in enumerate(names)}
    for token, kind in ((len(names), "uint16"), (70_000, "uint32")):  # numbers too large for two bytes get four
        packed, changes = M.merge((symbols, counts), [(number["##a"], number["##b"], token)])
        assert packed[0].dtype == kind and packed[0].tolist()[:4] == [number["a"], number["##b"], token, 0]
        expected = {("##a", "##b"): -3, ("##b", "##a"): -3, ("##b", token): 3}
        assert dict(zip(*(c.tolist() for c in changes))) == {number[a] << 32 | number.get(b, b): c for (a, b), c in expected.items()}
    packed, changes = M.merge((symbols, counts), [(number["##b"], number["##b"], 99)])
    assert packed[0] is symbols and len(changes[0]) == 0


def test_rounds_of_merges_run_a_task_for_each_core(spark):
    counts = {w: 3 + i for i, w in enumerate(["abab", "cdcd", "efef", "xyz", "xyxy"])}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    usual = {"spark.sql.shuffle.partitions": "70", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in usual}
    context = spark.sparkContext
    try:
        for key, value in usual.items():
            spark.conf.set(key, value)
        context.setJobGroup("merges", "merges")
        got = M.learn_merges(df, V.alphabet(df).coalesce(1), merges=6)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == merges_by_hand(counts, 6)
    jobs = sorted(context.statusTracker().getJobIdsForGroup("merges"))
    stages = context.statusTracker().getJobInfo(jobs[-1]).stageIds
    assert max(context.statusTracker().getStageInfo(s).numTasks for s in stages) == context.defaultParallelism


def test_a_round_takes_several_merges_and_size_counts_tokens(spark):
    counts = {w: 3 + i for i, w in enumerate(["abab", "cdcd", "efef", "xyz", "xyxy"])}
    front = M.Frontier(sorted({("##" if i else "") + c for w in counts for i, c in enumerate(w)}))
    pairs = {}
    for w, n in counts.items():
        s = [front.number[("##" if i else "") + c] for i, c in enumerate(w)]
        for a, b in zip(s, s[1:]):
            pairs[a << 32 | b] = pairs.get(a << 32 | b, 0) + n
    front.refill(sorted(pairs.items(), key=front.order), True)
    assert [t[2] for t in front.batch(99)] == ["xy", "##xy"]
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    vocab = V.assemble_vocab(V.alphabet(df), V.ranked_merges(V.learn_wordpiece(df, size=24)), 24)
    assert vocab.count() == 24


def test_vocab_alphabet_is_a_floor(spark):
    counts = spark.createDataFrame([("abc", 2)], "word string, n bigint")
    vocab = V.assemble_vocab(V.alphabet(counts), V.frequent_pieces(counts), 6)
    assert [r.token for r in vocab.orderBy("id").collect()] == ["[UNK]", "[CLS]", "[SEP]", "[PAD]", "[MASK]", "##b", "##c", "a"]
    more = V.assemble_vocab(V.alphabet(counts), V.frequent_pieces(counts), 10)
    assert [r.token for r in more.filter("id >= 8").orderBy("id").collect()] == ["##bc", "ab"]
    assert more.agg(F.count("*")).first()[0] == 10


def test_decomposition_is_that_of_the_standard(spark):
    """All assigned characters, alone, before marks and after them; marks in any order; nulls and long runs."""
    texts = []
    for first in range(0, 0x110000, 64):
        block = [chr(c) for c in range(first, first + 64) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
        if block:
            texts += ["".join(block), "\u0301".join(block) + "\u0323", "e\u0345\u0327".join(block)]
    draw = random.Random(5)
    marks = [chr(c) for c in range(0x300, 0x360)] + ["\u05b0", "\u0591", "\u093c", "\u094d", "\u0f71", "\u302e", "\u0903"]
    texts += ["".join(draw.choice("a\u00e9\ud55c" + "".join(marks)) for _ in range(60)) for _ in range(200)]
    texts += ["", "plain", "x" + "\u0323\u0301" * 5000]
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "i int, t string").repartition(8)
    got = {r.i: r.d for r in df.select("i", decompose("t").alias("d")).collect()}
    assert got.pop(-1) is None
    assert [i for i, t in enumerate(texts) if got[i] != unicodedata.normalize("NFD", t)] == []
    row = spark.createDataFrame([("\ud55c\uae00 \u1ed8n [CLS]",)], "t string")
    words = row.select(words_of("t", full=True).alias("w")).first().w
    assert words == ["\u1112\u1161\u11ab\u1100\u1173\u11af", "on", "[CLS]"]


def test_plain_texts_are_split_in_batches_as_by_expressions(spark):
    import random

    import pyarrow as pa

    from textmill.functions.text import is_plain, is_plain_run, runs_of, words_of
    from textmill.operators.splitting import split, words_in

    draw = random.Random(5)
    low = [chr(c) for c in [*range(1, 0x250), *range(0x2010, 0x2028)]]
    texts = ["", "  ", " a", "a  ", "--", "a\u00adb", "[MASK] a"] + [f"a{c}b {c}" for c in low]
    texts += ["".join(draw.choice(draw.choice(["ab -.Z", " \t\n", low])) for _ in range(draw.randint(0, 40))) for _ in range(2000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select(
        "i", "t", words_of("t").alias("w"), words_of("t", False).alias("cased"), runs_of("t").alias("r"),
        is_plain("t").alias("plain"), is_plain_run("t").alias("plain_run"),
    ).orderBy("i").collect()
    plain = [r for r in rows if r.plain]
    assert len(plain) > 1000 and not any(r.plain for r in rows if "\u00ad" in r.t or "[MASK]" in r.t)
    array, none = pa.array([r.t for r in plain]), pa.nulls(len(plain), pa.list_(pa.string()))
    assert words_in(array, none).to_pylist() == [r.w for r in plain]
    assert words_in(array, none, lower=False).to_pylist() == [r.cased for r in plain]
    spotted = words_in(array, none, blanks=True).to_pylist()
    assert [[w.lstrip(" ") for w in ws] for ws in spotted] == [r.w for r in plain]
    runs = [r for r in rows if r.plain_run]
    flat, count = split(pa.array([r.t for r in runs]), runs=True)
    assert flat.to_pylist() == [w for r in runs for w in r.r] and count.tolist() == [len(r.r) for r in runs]


def test_batches_with_other_texts_keep_their_words():
    import pyarrow as pa

    from textmill.operators.splitting import counter, words_in

    texts, given = pa.array(["a b", None, "", None]), pa.array([None, ["x", "a"], None, None], pa.list_(pa.string()))
    assert words_in(texts, given).to_pylist() == [["a", "b"], ["x", "a"], [], None]
    counts = {}
    for batch in counter()(iter([pa.RecordBatch.from_arrays([texts, given], ["text", "words"])])):
        for word, n in zip(*batch.to_pydict().values(), strict=True):
            counts[word] = counts.get(word, 0) + n
    assert counts == {"a": 2, "b": 1, "x": 1}


def test_to_ids_encodes_counted_words_only(spark, capsys):
    """A filter inferred for the explosion of pieces would go below the counting and encode every occurrence."""
    from textmill.plans import registry

    registry.queries()["to_ids"](spark, "/root/testdata/sf0.001").explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_counts_of_many_slices_are_summed():
    texts = pa.array(["one two", "two three"] * (splitting.SLICE // 8))
    batch = pa.RecordBatch.from_arrays([texts, pa.nulls(len(texts), pa.list_(pa.string()))], ["text", "words"])
    (made,) = splitting.counter()(iter([batch]))
    n = len(texts) // 2
    assert dict(zip(made.column("word").to_pylist(), made.column("n").to_pylist(), strict=True)) == {"one": n, "two": 2 * n, "three": n}


def test_pieces_of_a_batch_are_summed():
    batch = pa.RecordBatch.from_arrays([pa.array(["abc", "abd", "x", "\u00e9bc"]), pa.array([1, 2, 4, 8])], ["word", "n"])
    got = [r for b in splitting.piece_counter(100)(iter([batch])) for r in b.to_pylist()]
    want = {"ab": 3, "\u00e9b": 8, "##bc": 9, "##bd": 2, "abc": 1, "abd": 2, "\u00e9bc": 8}
    assert {r["token"]: r["n"] for r in got} == want and len(got) == len(want)
    letters = {r["token"]: r["n"] for b in splitting.letter_counter(iter([batch])) for r in b.to_pylist()}
    assert letters == {"a": 3, "\u00e9": 8, "x": 4, "##b": 11, "##c": 9, "##d": 2}


def test_decode_stays_in_the_row(spark):
    vocab = make_vocab(spark, ["do", "##n"])
    df = spark.createDataFrame([(1, [5, 6, 99, None]), (1, [1, 2]), (2, []), (3, None)], "k int, ids array<int>")
    made = T.decode(df, ["k"], "ids", vocab)
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.k, r.text) for r in made.collect()) == [(1, ""), (1, "don"), (2, ""), (3, "")]


def test_characters_are_asked_of_texts_without_moving_their_tokens(spark):
    """Right behind token_offsets no token leaves its text but those asked for; the answers are those of the range join."""
    vocab = make_vocab(spark, ["a", "##a", "x", "##z", "cafe", "ok", "."])
    texts = spark.createDataFrame([*enumerate(ODD), (100, "a a"), (100, "ok a"), (101, None), (102, ""), (None, "a")], "k int, text string")
    asked = [(k, at, n) for k in [*range(len(ODD)), 100, 101, 102, 500] for n, at in enumerate([-1, *range(12), 201, 10**12])]
    chars = spark.createDataFrame([*asked, (0, 0, 99), (0, None, 98), (None, 0, 97)], "k int, at bigint, n int")
    offsets = T.token_offsets(texts, ["k"], "text", vocab)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    got = T.char_to_token(offsets, chars, ["k"], "at")
    other = T.char_to_token(offsets.select("*"), chars, ["k"], "at")
    assert got.columns == other.columns and rows(got) == rows(other) and got.filter("token is not null").count() > 30
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in plan(other) and "_bucket" not in plan(got)
    narrow = chars.withColumn("at", F.col("at").cast("double") + 0.5)  # places that are no whole numbers
    assert rows(T.char_to_token(offsets, narrow, ["k"], "at")) == rows(T.char_to_token(offsets.select("*"), narrow, ["k"], "at"))
