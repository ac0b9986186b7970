"""Results against brute force on a small fixture."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from textmill.llm import chat, decontaminate, language, orc_ids, packing, personal, quality, queries, repeats, sharding, simhash
from textmill.llm.queries import tokenizer_file
from textmill.llm.token_ids import id_encoder

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{FOLDER}/documents.parquet'").fetchall())


def result(spark, name):
    return queries.queries()[name](spark, FOLDER).collect()


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_language_on_held_out_documents(spark):
    true = dict(duckdb.sql(f"select doc_id, lang from '{FOLDER}/documents.parquet'").fetchall())
    rows = result(spark, "op1_language")
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in true if zlib.crc32(str(d).encode()) % 4 == 2}
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([true[r.doc_id] == r.lang_pred for r in held]) >= 0.9


def test_language_gradients():
    settings = language.Settings(window=12)
    net = language.Network(["a", "b"], settings)
    cuts = [language.cut(t, 12) for t in (b"hello world!", b"hm", b"other text")]
    rows, lengths, labels = np.concatenate([c[0] for c in cuts]), np.concatenate([c[1] for c in cuts]), np.array([0, 1, 1])

    def loss():
        inside = np.arange(12)[:, None] < lengths
        return -(np.log(net.positions(rows, lengths)[:, np.arange(3), labels]) * inside).sum() / inside.sum()

    for name, g in net.gradients(rows, lengths, labels).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = net.w[name][at]
        net.w[name][at] = old + 1e-2
        up = loss()
        net.w[name][at] = old - 1e-2
        down = loss()
        net.w[name][at] = old
        assert (up - down) / 2e-2 == pytest.approx(g[at], rel=0.02, abs=1e-4), name


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def base_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                found.append((m.start(), k, m.end(), kind))
    return sorted(found)


def test_personal_spans(spark, docs):
    hard = {
        -1: "a@b.c_d@e.f x@y.z.", -2: "1.2.3.4.5.6.7.8 300.1.1.1 0000255.1.2.3", -3: "é😀 a@b.cc 4111-1111-1111-1111",
        -4: "a@b" + ".c" * 5000, -5: "+1+2 345 678 901 2--", -6: "4111 1111 1111 1111 " * 300, -7: "x" * 200_000 + "@",
        -8: "+1 (755) 555-9729)", -9: "9" * 400,
    }
    texts = docs | hard
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for row in personal.personal_spans(table).collect():
        spans = base_spans(texts[row.doc_id])
        written = [f"{kind}:{a}:{b}" for a, _, b, kind in spans]
        assert row.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest(), row.doc_id
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[3] == k for s in spans) for k in BASE]
        assert set(written) <= set(row.spans.split(",")) | {""}
    for row in personal.redact(table).collect():
        if row.doc_id != -9:
            assert not base_spans(row.text)
        if not base_spans(texts[row.doc_id]):
            assert row.doc_id < 0 or row.text == texts[row.doc_id]


def test_sharding(spark, docs):
    rows = result(spark, "op3_sharding")
    assert len(rows) == len(docs) and {r.shard for r in rows} == set(range(16))
    size, slots, places = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        data = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "bytes")
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        places[docs[r.doc_id]].add(r.shard)
    assert max(size.values()) - min(size.values()) <= 0.01 * sum(size.values()) / 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(p) == 1 for p in places.values())


def test_differencing_levels_agree_on_groups(spark):
    groups = spark.range(500).selectExpr("id as item", "1 + id * id % 97 as weight")
    shards = sharding.shard_groups(groups, 4, buckets=20, fan=3).join(groups, "item").collect()
    sums = Counter()
    for r in shards:
        sums[r.shard] += r.weight
    assert len(shards) == 500 and max(sums.values()) - min(sums.values()) <= 20


def test_decontamination(spark, docs):
    words = lambda t: " " + " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())) + " "
    items = [words(t) for (t,) in duckdb.sql(f"select text from '{FOLDER}/benchmark.parquet'").fetchall()]
    want = {d for d, t in docs.items() if any(i in words(t) for i in items)}
    got = {r.doc_id for r in result(spark, "op4_decontaminate") if r.contaminated}
    assert want and got >= want and len(got - want) <= 1


def test_decontamination_finds_paraphrases_and_blocks(spark, docs):
    draw = random.Random(3)
    items = [" ".join(f"w{draw.randrange(3000)}" for _ in range(30)) for _ in range(40)]
    texts = [" ".join(f"w{draw.randrange(3000)}" for _ in range(300)) for _ in range(200)]
    for i in range(40):  # every seventh word another, the answer kept
        said = [w if k % 7 or k > 20 else "other" for k, w in enumerate(items[i].split())]
        place = texts[i].split()
        texts[i] = " ".join(place[:100] + said + place[100:])
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    settings = decontaminate.Settings(items_at_once=15)
    rows = decontaminate.contamination(table, bench, settings).where("contaminated").collect()
    assert all(r.item_id == r.doc_id for r in rows) and len(rows) >= 36
    kept = {r.doc_id for r in decontaminate.drop_contaminated(table, bench, settings).collect()}
    assert kept == set(range(200)) - {r.doc_id for r in rows}


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, most):
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in prints}


def test_simhash(spark, docs):
    prints = {d: plain_print(t) for d, t in docs.items()}
    want = components(prints, 3)
    rows = result(spark, "op5_simhash")
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == {d: (prints[d], want[d]) for d in docs}


def test_links_for_all_plans(spark, monkeypatch):
    draw = random.Random(5)
    found = [draw.getrandbits(64) for _ in range(60)]
    found += [p ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 5))) for p in found for _ in range(4)]
    signed = sorted({simhash.signed(p) for p in found})
    table = spark.createDataFrame([(p,) for p in signed], "print long")
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    plans = [([2, 62], [1, 1]), ([21, 21, 22], [1, -1, 1]), ([21, 21, 22], [2, -1, 0]), ([16] * 4, [0, 0, 0, 0])]
    for sizes, thresholds in plans:
        ends = np.cumsum(sizes)
        parts = [list(range(e - n, e)) for e, n in zip(ends, sizes, strict=True)]
        monkeypatch.setattr(simhash, "plan_parts", lambda *_, p=parts, t=thresholds: simhash.Plan(p, t, 0.0))
        assert {(r.a, r.b) for r in simhash.links(table, 3).collect()} == want
    assert simhash.allocate([[0, 5, 9, 99, 100], [0, 50, 60, 70, 80]], 0) == (9, [1, -1])


def test_chat_round_trip_and_sql(spark):
    draw, bits = random.Random(1), ["[", "<", "\\", "INST]", "/INST]", "[INST]", "</s>", "<s>", "\n", "[/INST]\n", "a", "/s>"]
    for _ in range(3000):
        role = draw.choice(["user", "assistant", "".join(draw.choices(bits, k=2))])
        text = "".join(draw.choices(bits, k=draw.randint(0, 7)))
        assert [t[:2] for t in chat.parse(chat.format_turn(role, text) * 2)] == [(role, text)] * 2
        assert chat.unescape(chat.escape(text)) == text
    con = duckdb.connect()
    con.execute(f"create view conversations as from '{FOLDER}/conversations.parquet'")
    cols = "conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars"
    assert {tuple(r) for r in result(spark, "op6_chat")} == set(con.sql(f"select {cols} from ({chat.SQL})").fetchall())


def removed(texts, least=200):
    counts, out = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1)), []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - least + 1):
            if counts[t[i : i + least]] > 1:
                mark[i : i + least] = b"\1" * least
        spans = sum(m and (i == 0 or not mark[i - 1]) for i, m in enumerate(mark))
        out.append((len(t), sum(mark), spans, hashlib.sha256(bytes(c for c, m in zip(t, mark, strict=True) if not m)).hexdigest()))
    return out


@pytest.mark.parametrize("bucket_bytes", [2 << 20, 2000])
def test_repeats(spark, docs, bucket_bytes):
    """The small bucket forces anchors to be split down to single strings."""
    texts = [t for t in docs.values() if len(t) < 4000][:80]
    passage = texts[3][:600]
    texts += ["", "a" * 900, "ab" * 500 + "é" * 200, passage[:199], passage[:200], passage[90:291], passage[90:291], "x" * 200, "q" + passage]
    texts += [texts[i][:60] + passage[40 : 250 + 9 * i] + texts[i + 30][:300] for i in range(30)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:5] for r in repeats.remove_repeats(rows, bucket_bytes=bucket_bytes).collect()}
    assert got == dict(enumerate(removed([t.encode() for t in texts])))


def test_interval_expansion():
    draw = random.Random(2)
    for _ in range(100):
        letters = draw.choice([b"a", b"ab", bytes(range(256))])
        base = bytes(draw.choices(letters, k=120))
        parts = [base[(a := draw.randrange(100)) : a + draw.randint(1, 90)] for _ in range(draw.randint(1, 6))]
        least = draw.randint(1, 25)
        counts = Counter(p[i : i + least] for p in parts for i in range(len(p) - least + 1))
        want = [[i for i in range(len(p) - least + 1) if counts[p[i : i + least]] > 1] for p in parts]
        assert [x.tolist() for x in repeats.repeated_starts(parts, least)] == want


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_ids_equal_the_tokenizer(name):
    path = tokenizer_file(name)
    whole, own, draw = Tokenizer.from_file(path), id_encoder(path), random.Random(4)
    bits = ["a", "B", "é", " ", "  ", "\n", "\r", "\t", "\x1c", "\x0b", "\x85", "\xa0", " ", "'s", "'", "’", "1", "23", ".", "?!", "中",
            "é", "́", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "İ", "ß", "µ", "😀", "​", "\x00", "I'LL", "　", "²"]
    for _ in range(4000):
        text = "".join(draw.choices(bits, k=draw.randint(0, 9)))
        ids = np.frombuffer(own(text), dtype="<u2").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_orc_positions_and_pruned_reads(spark, docs, tmp_path):
    whole, start = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json")), 0
    got = {r.doc_id: tuple(r)[1:] for r in result(spark, "op8_orc_ids")}
    for d in sorted(docs):
        ids = whole.encode(docs[d], add_special_tokens=False).ids + [1]
        assert got[d] == (start, len(ids), crc(ids))
        start += len(ids)
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    orc_ids.write_ids(table, str(tmp_path / "ids"), tokenizer_file("word_bpe_49k.json"), files=4)
    some = orc_ids.read_ids(spark, str(tmp_path / "ids"), wanted=[3, 150])
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString()
    assert {r.doc_id for r in some.collect()} == {3, 150}


def test_quality(spark, docs):
    for r in result(spark, "op9_quality"):
        text = docs[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        inside = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines, seen, again = text.split("\n"), set(), 0
        for line in lines:
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), sum(c in "[#*$%&|<>]"[1:-1] for c in text))
        assert (r.n_dup_lines, r.n_repeat_words, r.base_failed) == (again, len(inside), failed)
        assert not (failed and r.kept)


def test_bands_reject_both_ends():
    import base64

    import zstandard

    draw, packer = random.Random(6), zstandard.ZstdCompressor(level=3)
    verdict = lambda data: quality.band_verdict(data, quality.Bands(), packer)[2]
    prose = " ".join("".join(draw.choices("etaoinshrdlucmf", k=draw.randint(2, 9))) for _ in range(3000)).encode()
    assert verdict(prose) and verdict(b"") and verdict(b"short")
    assert not verdict(b"buy now! " * 500) and not verdict(bytes(draw.choices(range(256), k=9000)))
    assert not verdict(prose[:6000] + base64.b64encode(b"\0" * 6000))


def drr(queues, quantum, grain):
    """Deficit round-robin as it is told: windows one after the other, packets of ``grain`` tokens."""
    deficit, at, order = [0.0] * len(queues), [0] * len(queues), []
    for window in range(1, 10_000):
        if all(a >= n for a, n in zip(at, queues, strict=True)):
            return order
        for s, n in enumerate(queues):
            deficit[s] = np.floor(window * quantum[s] / grain) * grain - min(at[s], np.floor((window - 1) * quantum[s] / grain) * grain)
            serve = int(min(deficit[s], n - at[s]))
            order += [(s, at[s] + i) for i in range(serve)]
            at[s] += serve
    raise AssertionError("not served")


def test_packing_mixture_is_deficit_round_robin():
    totals, window = [5000, 700, 33], 1000
    quantum = [n / sum(totals) * window for n in totals]
    mixture = packing.Mixture(list("abc"), totals, [float(n) for n in totals], window, grain=16)
    place = {}
    for s, n in enumerate(totals):
        for a in range(0, n, 37):
            for first, many, at in mixture.runs("abc"[s], a, min(n, a + 37)):
                place |= {at + i: (s, first + i) for i in range(many)}
    assert sorted(place) == list(range(sum(totals)))
    for k in range(window, 5 * window, window):  # shares hold within a packet of each source
        seen = Counter(s for at, (s, _) in place.items() if at < k)
        assert all(abs(seen[s] - k * n / sum(totals)) <= 16 * 3 for s, n in enumerate(totals))
    assert [place[i] for i in range(len(place))][:2000] == drr(totals, quantum, 16)[:2000]


def test_packing(spark, docs):
    whole, rows = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json")), result(spark, "op10_packing")
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for d, found in pieces.items():
        ids, at = whole.encode(docs[d], add_special_tokens=False).ids + [0], 0
        for start, length, check, n in sorted(found):
            assert start == at and n == len(ids) and check == crc(ids[start : start + length])
            at += length
        assert at == len(ids)
    full = []
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        full.append(at)
    assert sorted(sequences) == list(range(len(sequences))) and sum(n < 1024 for n in full) <= 1 and max(full) <= 1024


def test_packing_with_targets(spark, docs):
    table = spark.createDataFrame([(d, t, f"s{d % 3}") for d, t in docs.items()], "doc_id long, text string, source string")
    rows = packing.pack(table, tokenizer_file("byte_bpe_50k.json"), window=8, targets={"s0": 0.7, "s1": 0.3}).collect()
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
    first = Counter()
    for r in rows:
        if r.sequence_id < 24:
            first[r.source] += r.length
    assert abs(first["s0"] / first.total() - 0.7) < 0.05 and first["s2"] == 0
