"""Building blocks of the reference SQL (DuckDB dialect) that results are compared with.

A block is a named common table expression; :func:`query` puts the wanted blocks, and the blocks they
name, in front of a final select.
"""

from __future__ import annotations

import re

# Written out here, so that the reference SQL does not follow the library's own patterns. Fixed values of the
# tokenizer format: punctuation and the eight ideograph blocks; and runs for vocabulary learning.
PUNCTUATION = r"!-/:-@\[-`{-~\p{P}"
IDEOGRAPHS = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)
WORD = rf"[{PUNCTUATION}]|[^\p{{Z}}{PUNCTUATION}]+"
SPOTTED = rf"([\p{{Z}}\t\n\r]*)([{PUNCTUATION}]|[^\p{{Z}}\t\n\r{PUNCTUATION}]+)"
RUN = r"[\p{L}\p{M}\p{N}\p{Pc}]+|[^\p{L}\p{M}\p{N}\p{Pc}\p{Z}\s]+"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
VOCAB_SIZE = 2000
PART: dict[str, str] = {}


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def folded(x: str) -> str:
    return f"strip_accents(lower({x}))"


def cleaned(x: str) -> str:
    spaced = f"translate({x}, chr(9) || chr(10) || chr(13), '   ')"
    dropped = f"regexp_replace({spaced}, {q('[' + chr(92) + 'p{C}' + chr(92) + 'x{FFFD}]+')}, '', 'g')"
    return f"regexp_replace({dropped}, {q('([' + IDEOGRAPHS + '])')}, ' \\1 ', 'g')"


def words(x: str, lower: bool = True) -> str:
    text = folded(cleaned(x)) if lower else cleaned(x)
    return f"regexp_extract_all({text}, {q(WORD)})"


def draw(tag: str, *keys: str, seed: int = 0) -> str:
    listed = ", ".join([f"'{seed}'", f"'{tag}'", *keys])
    return f"(('0x' || substr(md5(concat_ws(':', {listed})), 1, 8))::BIGINT::DOUBLE / 4294967296::DOUBLE)"


def shown(x: str) -> str:
    return f"array_to_string({x}, ' ')"


def repeated(value: str, n: str) -> str:
    return f"list_transform(range(greatest(({n})::BIGINT, 0)), lambda _x: ({value})::INTEGER)"


def query(final: str, extra: dict[str, str] | None = None) -> str:
    parts = {**PART, **(extra or {})}
    ordered: list[str] = []

    def visit(text: str, seen: tuple = ()) -> None:
        for name in parts:
            if name not in seen and name not in ordered and re.search(rf"\b{name}\b", text):
                visit(parts[name], (*seen, name))
                if name not in ordered:
                    ordered.append(name)

    visit(final)
    if not ordered:
        return final
    blocks = []
    for name in ordered:
        recursive = re.search(r"\bUNION ALL\b", parts[name]) and re.search(rf"\b{name}\b", parts[name])
        # A recursive block carries its own column list in its first select.
        blocks.append(f"{name} AS {'' if recursive else 'MATERIALIZED '}({parts[name]})")
    return "WITH RECURSIVE " + ",\n".join(blocks) + "\n" + final


PART["doc_lines"] = f"""
  SELECT doc_id, line_no, trim(raw, {BLANKS}) AS line
  FROM (SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS raw
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
  WHERE trim(raw, {BLANKS}) <> ''"""
PART["run_counts"] = f"""
  SELECT word, count(*) AS n
  FROM (SELECT unnest(regexp_extract_all({folded('text')}, {q(RUN)})) AS word FROM documents) GROUP BY word"""
PART["letters"] = """
  SELECT (CASE WHEN i = 1 THEN '' ELSE '##' END) || substr(word, i, 1) AS token, sum(n)::BIGINT AS n
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM run_counts) GROUP BY 1"""
PART["piece_counts"] = """
  SELECT token, sum(n)::BIGINT AS n FROM (
    SELECT substr(word, 1, k) AS token, n
    FROM (SELECT word, n, unnest(range(2, least(length(word), 100) + 1)) AS k FROM run_counts)
    UNION ALL
    SELECT '##' || substr(word, length(word) - k + 1, k) AS token, n
    FROM (SELECT word, n, unnest(range(2, least(length(word) - 1, 100) + 1)) AS k FROM run_counts)
  ) GROUP BY token"""
PART["vocab"] = f"""
  SELECT token, id::INTEGER AS id, source FROM (
    SELECT token, grp, source, row_number() OVER (ORDER BY grp, n DESC, token) - 1 AS id FROM (
      SELECT * FROM (VALUES ('[UNK]', 0, 0, 'special'), ('[CLS]', 0, -1, 'special'), ('[SEP]', 0, -2, 'special'),
                            ('[PAD]', 0, -3, 'special'), ('[MASK]', 0, -4, 'special')) s(token, grp, n, source)
      UNION ALL SELECT token, 1, n, 'letter' FROM letters
      UNION ALL SELECT token, 2, n, 'piece'
        FROM (SELECT token, n FROM piece_counts ORDER BY n DESC, token LIMIT {VOCAB_SIZE})
        WHERE token NOT IN (SELECT token FROM letters)))
  WHERE grp < 2 OR id < {VOCAB_SIZE}"""


def code_parts(name: str, words_sql: str) -> dict[str, str]:
    """Blocks that give the pieces of the distinct words listed by ``words_sql``, as ``{name}_codes``."""
    return {
        f"{name}_words": words_sql,
        f"{name}_best": f"""
  SELECT word, start, max(len) AS len FROM (
    SELECT word, start, unnest(range(1, least((SELECT max(length(token)) FROM vocab), length(word) - start + 1) + 1)) AS len
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS start FROM {name}_words WHERE length(word) <= 100)
  ) c JOIN vocab v ON v.token = (CASE WHEN start > 1 THEN '##' ELSE '' END) || substr(word, start, len)
  GROUP BY word, start""",
        f"{name}_walk": f"""
  SELECT word, 1::BIGINT AS at, 0 AS piece_no, NULL::VARCHAR AS token FROM {name}_words
  UNION ALL
  SELECT w.word, w.at + b.len, w.piece_no + 1,
         (CASE WHEN w.at > 1 THEN '##' ELSE '' END) || substr(w.word, w.at, b.len)
  FROM {name}_walk w JOIN {name}_best b ON b.word = w.word AND b.start = w.at""",
        f"{name}_codes": f"""
  SELECT word, CASE WHEN max(w.at) = length(word) + 1 AND length(word) <= 100
                    THEN list(w.token ORDER BY piece_no) FILTER (piece_no > 0) ELSE ['[UNK]'] END AS pieces,
         CASE WHEN max(w.at) = length(word) + 1 AND length(word) <= 100
              THEN list(v.id ORDER BY piece_no) FILTER (piece_no > 0) ELSE [0] END AS ids
  FROM {name}_walk w LEFT JOIN vocab v ON v.token = w.token GROUP BY word""",
    }


PART["line_occ"] = f"""
  SELECT doc_id, line_no, unnest(range(len(ws))) AS pos, unnest(ws) AS word
  FROM (SELECT doc_id, line_no, {words('line')} AS ws FROM doc_lines)"""
PART.update(code_parts("line", "SELECT DISTINCT word FROM line_occ"))
PART["encoded"] = """
  SELECT l.doc_id, l.line_no, coalesce(ids, []) AS ids
  FROM doc_lines l LEFT JOIN (
    SELECT doc_id, line_no, flatten(list(ids ORDER BY pos)) AS ids
    FROM line_occ o JOIN line_codes c ON c.word = o.word GROUP BY doc_id, line_no) e
  ON e.doc_id = l.doc_id AND e.line_no = l.line_no"""
PART["numbered"] = """
  SELECT doc_id, line_no, ids, len(ids) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS i
  FROM encoded"""


def target(doc: str, length: str, first: str) -> str:
    return (
        f"(CASE WHEN {draw('short', doc, length, first)} < 0.05 "
        f"THEN 5 + floor({draw('target', doc, length, first)} * ({length} - 4))::INTEGER ELSE {length} END)"
    )


def goal(doc: str, length: str, ex: str, target_: str) -> str:
    return (
        f"(CASE WHEN {draw('single', doc, length, ex)} < 0.1 THEN 100000 "
        f"ELSE floor(({target_} - 3) / 2)::INTEGER END)"
    )


def pack_part(lengths: list[int]) -> str:
    """One row per line: which example and segment it goes to. A walk along the lines of a document."""
    listed = ", ".join(f"({n})" for n in lengths)
    first = (
        "(la = 0 OR la + n < goal OR (lb = 0 AND la < goal AND "
        + draw("side", "doc_id", "max_len", "ex", "line_no") + " < 0.5))"
    )
    return f"""
  SELECT doc_id, max_len, 0::BIGINT AS i, -1 AS ex, 0 AS tokens, 0 AS target, 0 AS la, 0 AS lb, 0 AS goal,
         true AS closed, ''::VARCHAR AS seg, 0::BIGINT AS n
  FROM (SELECT DISTINCT doc_id FROM numbered), (VALUES {listed}) t(max_len)
  UNION ALL
  SELECT doc_id, max_len, i, ex, (tokens + n)::INTEGER, target,
         (CASE WHEN first THEN la + n ELSE la END)::INTEGER, (CASE WHEN first THEN lb ELSE lb + n END)::INTEGER,
         goal, tokens + n >= target, CASE WHEN first THEN 'a' ELSE 'b' END, n
  FROM (SELECT *, {first} AS first FROM (
    SELECT *, CASE WHEN was_closed THEN {goal('doc_id', 'max_len', 'ex', 'target')} ELSE old_goal END AS goal FROM (
      SELECT *, CASE WHEN was_closed THEN {target('doc_id', 'max_len', '(i - 1)')} ELSE old_target END AS target FROM (
        SELECT p.doc_id, p.max_len, m.i, m.line_no, m.n, p.closed AS was_closed,
               CASE WHEN p.closed THEN p.ex + 1 ELSE p.ex END AS ex,
               CASE WHEN p.closed THEN 0 ELSE p.tokens END AS tokens,
               CASE WHEN p.closed THEN 0 ELSE p.la END AS la, CASE WHEN p.closed THEN 0 ELSE p.lb END AS lb,
               p.target AS old_target, p.goal AS old_goal
        FROM packed p JOIN numbered m ON m.doc_id = p.doc_id AND m.i = p.i + 1))))"""


PART["packed"] = pack_part([128])
PART["segments"] = """
  SELECT p.doc_id, p.max_len, p.ex, max(p.target) AS target, count(*) AS n_lines, min(m.line_no) AS first_line,
         coalesce(flatten(list(m.ids ORDER BY p.i) FILTER (p.seg = 'a')), []) AS a,
         coalesce(flatten(list(m.ids ORDER BY p.i) FILTER (p.seg = 'b')), []) AS b
  FROM packed p JOIN numbered m ON m.doc_id = p.doc_id AND m.i = p.i
  GROUP BY p.doc_id, p.max_len, p.ex HAVING sum(p.n) > 0"""
PART["examples"] = f"""
  SELECT doc_id, max_len, ex, input_ids || {repeated('0', 'max_len - len(input_ids)')} AS input_ids,
         {repeated('1', 'len(input_ids)')} || {repeated('0', 'max_len - len(input_ids)')} AS input_mask,
         {repeated('0', 'len(a) + 2')} || {repeated('1', 'CASE WHEN len(b) > 0 THEN len(b) + 1 ELSE 0 END')}
           || {repeated('0', 'max_len - len(input_ids)')} AS segment_ids
  FROM (SELECT *, [1] || a || [2] || CASE WHEN len(b) > 0 THEN b || [2] ELSE [] END AS input_ids
        FROM (SELECT doc_id, max_len, ex, a[1:max_len - 2] AS a,
                     b[1:greatest(0, max_len - len(a[1:max_len - 2]) - 3)] AS b FROM segments))"""
