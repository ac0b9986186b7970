"""Results that must be whole: copies, spans and rows that an earlier version lost."""

import random

import pytest

from textmill.llm import decontaminate, orc_ids, personal, repeats, simhash
from textmill.llm.queries import tokenizer_file
from textmill.session import new_folder


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


@pytest.mark.parametrize("size", [16, 24, 34, 50])
def test_copies_of_a_hot_item_are_all_found(spark, size):
    draw = random.Random(size)
    word = lambda: f"w{int(3000 * draw.random() ** 2)}"
    items = [[word() for _ in range(size)] for _ in range(6)]
    texts = [[word() for _ in range(draw.randrange(40, 200))] for _ in range(300)]
    for i, text in enumerate(texts):
        if i % 3 == 0:  # the first item, every second time with words left out or put in
            said = list(items[0])
            if i % 2:
                for at in draw.sample(range(1, size - 1), size // 10):
                    said[at] = word()
                said.insert(size // 2, word())
            at = draw.randrange(len(text))
            text[at:at] = said
    want = set()
    for i, text in enumerate(texts):
        spread = size + size // 4
        if any(
            len(set(item) & set(text)) >= size // 2
            and any(longest_common(item, text[a : a + spread]) >= 0.8 * size for a in range(len(text)))
            for item in items
        ):
            want.add(i)
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    rows = decontaminate.contamination(table, bench).where("contaminated").collect()
    got = {r.doc_id for r in rows}
    print(size, "recall", len(want & got) / len(want), "more", len(got - want))
    assert len(want) >= 100 and got == want and all(r.item_id == 0 for r in rows)
    assert {r.doc_id for r in decontaminate.drop_contaminated(table, bench).collect()} == set(range(300)) - want


def test_short_items_and_scripts_without_spaces(spark):
    items = ["Quartz", "blue zebra", "old tin roof!", "今天的天气非常好，我们去公园散步吧。", "東京タワーの高さは三百三十三メートルです。", "ประเทศไทยมีเมืองหลวงชื่ออะไร", "\u2014\u3002"]
    filler = "some plain words that stand before and after it"
    hits = [f"{filler} {items[0]}, {filler}", f"{filler} Blue\u2014Zebra {filler}", f"{filler} \u201cold tin roof\u201d"]
    hits += [f"昨天下雨了{items[3]}后来又下雨了", f"問題：{items[4]}はい。", f"คำถาม{items[5]}ตอบ"]
    clean = ["quartzite", "blue and zebra", "zebra blue", "old roof tin", "今天的公园很好", "東京の天気", "ประเทศอื่น", "\u3002\u3002", ""]
    table = spark.createDataFrame(list(enumerate(hits + clean)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = decontaminate.contamination(table, bench).collect()
    assert {r.doc_id: r.item_id for r in rows if r.contaminated} == {i: i for i in range(len(hits))}
    assert all(r.word_share == 1 for r in rows if r.contaminated)
    left = decontaminate.drop_contaminated(table, bench).collect()
    assert {r.doc_id for r in left} == {r.doc_id for r in rows if not r.contaminated}


@pytest.mark.parametrize("share", [0.01, 0.1, 0.5, 1.0])
def test_written_out_addresses_are_found_however_many(spark, share):
    draw = random.Random(7)
    texts, planted, prose = [], {}, set()
    for i in range(600):
        name, host = f"user{draw.randrange(999)}", f"host{draw.randrange(99)}"
        if draw.random() < share:
            said = f"{name} at {host} dot org"
            planted[i] = ("email", said)
        else:
            said = f"{name}@{host}.org"
        if i % 10 == 9:
            said, _ = "we met at noon dot matrix printers", planted.pop(i, None)
            prose.add(i)
        texts.append(f"please write to {said} soon")
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in personal.personal_spans(table).collect()}
    assert planted
    for i, (kind, said) in planted.items():
        at = texts[i].index(said)
        assert spans[i] == f"{kind}:{at}:{at + len(said)}", texts[i]
    assert all(spans[i] == "" for i in prose)
    assert all(r.text == "please write to [EMAIL] soon" for r in personal.redact(table).collect() if r.doc_id in planted)


def test_one_row_stays_for_each_component(spark):
    """A doc_id on unlike texts loses none of them; copies without a doc_id go; of repeated rows one stays."""
    draw = random.Random(1)
    prose = lambda: " ".join(f"w{draw.randrange(5000)}" for _ in range(300))
    a, b, c = prose(), prose(), prose()
    rows = [(1, a, "x"), (1, b, "y"), (2, a, "z"), (None, a, "n"), (None, c, "n"), (None, c, "n"), (3, c, "k"), (4, None, "e"), (5, "", "e")]
    rows += [(6, prose(), "r")] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string, _row string").repartition(4)
    kept = simhash.keep_one(table).collect()
    assert {r._row for r in kept} <= set("xyznker")
    assert sorted((r.doc_id, r.text or "") for r in kept) == sorted([(1, a), (1, b), (3, c), (4, ""), (6, rows[-1][1])])


def test_strings_over_the_field_are_an_error(spark):
    table = spark.createDataFrame([(1, "ab" * 900)], "doc_id long, text string")
    with pytest.raises(ValueError):
        repeats.remove_repeats(table, least=1200)
    text = "".join(random.Random(2).choice("abcdefgh") for _ in range(2000))
    pair = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    assert [r.n_removed for r in repeats.remove_repeats(pair, least=repeats.LONGEST).collect()] == [2000, 2000]


def test_positions_are_right_where_files_are_cut(spark):
    rows = [(i, f"text {i} " * (i % 7)) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 50)
    try:
        folder = new_folder(spark, "orc-test")
        orc_ids.write_ids(table, folder, tokenizer_file("word_bpe_49k.json"), files=2)
        found = sorted(orc_ids.document_positions(spark, folder).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens


def test_context_decides_over_the_format(spark):
    """Precision and recall by kind of the added spans, on sentences whose truth is in what is said, not in the format."""
    draw = random.Random(11)
    digits = lambda n: "".join(draw.choice("0123456789") for _ in range(n))

    def luhn_sum(text: str) -> int:
        turned = [int(c) for c in reversed(text) if c.isdigit()]
        return sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(turned))

    def card() -> str:
        stem = digits(15)
        whole = stem + str(-luhn_sum(stem + "0") % 10)
        return "/".join(whole[i:i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        while True:  # one that passes as a card is a base span of that kind
            value = f"0049 {digits(2)} {digits(4)} {digits(4)}"
            if luhn_sum(value) % 10:
                return value

    make = {
        "email": (lambda: f"{draw.choice(['eva', 'tom', 'lee.k', 'kim88'])} at {draw.choice(['school', 'lab'])} dot org",
                  ["you can mail ", "contacto: ", "do write to "], ["they ", "all of us ", "later on "]),
        "ip": (lambda: "[.]".join(str(draw.randrange(256)) for _ in range(4)),
               ["that server ", "on host ", "new address "], ["firmware version ", "this release ", "see section "]),
        "card": (card, ["pay by card ", "the visa ", "carte "], ["your order ", "serial ", "open invoice "]),
        "phone": (phone,
                  ["just call ", "my phone ", "mobile: "], ["your order ", "serial ", "see isbn "]),
    }
    rows, truth = [], {}
    for kind, (said, announced, prose) in make.items():
        for i in range(120):
            value, yes = said(), i % 2 == 0
            if kind == "email" and not yes:
                value = f"{draw.choice(['met', 'stopped', 'rested'])} at {draw.choice(['noon', 'geneva'])} dot de"
            lead = draw.choice(announced if yes else prose)
            truth[len(rows)] = (kind, f"{kind}:{len(lead)}:{len(lead) + len(value)}", yes)
            rows.append((len(rows), f"{lead}{value} today"))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: set(r.spans.split(",")) for r in personal.personal_spans(table).collect()}
    for kind in make:
        mine = [(span in found[i], yes) for i, (k, span, yes) in truth.items() if k == kind]
        hits = sum(got and yes for got, yes in mine)
        missed = [rows[i][1] for i, (k, span, yes) in truth.items() if k == kind and yes and span not in found[i]]
        assert hits >= 0.9 * sum(yes for _, yes in mine), (kind, missed)
        assert hits >= 0.95 * sum(got for got, _ in mine), kind
