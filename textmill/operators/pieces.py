"""Word pieces inside Arrow batches: the distinct words of a batch are matched side by side, a character of all of them at
a time, and all else is array arithmetic."""

from __future__ import annotations

import os
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from textmill.operators.splitting import characters

# Cells of a table of all nodes by all characters; where there would be more, edges are searched.
DENSE = 1 << 24
# Characters whose words are coded at once, so that a large batch takes no more memory; a longer text goes alone.
CODED = 1 << 20
# Stands ahead of the words of each given token, where the words of several come in one array. Words never hold it.
MARK = "\x02"


class Trie:
    """Tokens by their characters, a first node for each of several sets of them. Character 0 is no token's."""

    NONE = np.iinfo(np.int64).min

    def __init__(self, *sets: dict[str, int]):
        letters = sorted({c for tokens in sets for token in tokens for c in token})
        number = {c: i + 1 for i, c in enumerate(letters)}
        self.width = len(letters) + 1
        self.letters = np.zeros(max(map(ord, letters), default=0) + 2, dtype=np.int64)  # the last stands for all beyond
        self.letters[[ord(c) for c in letters]] = np.arange(1, self.width)
        edges: dict[int, int] = {}
        ids = [self.NONE] * len(sets)
        for root, tokens in enumerate(sets):
            for token, i in tokens.items():
                node = root
                for c in token:
                    node = edges.setdefault(node * self.width + number[c], len(ids))
                    if node == len(ids):
                        ids.append(self.NONE)
                ids[node] = i
        self.ids = np.array(ids, dtype=np.int64)
        self.keys = np.array(sorted(edges), dtype=np.int64)
        self.nodes = np.array([edges[k] for k in self.keys.tolist()], dtype=np.int64)
        self.table = None
        if not edges or len(ids) * self.width <= DENSE:
            self.table = np.full(len(ids) * self.width, -1, dtype=np.int32)
            self.table[self.keys] = self.nodes

    def numbered(self, codes: np.ndarray) -> np.ndarray:
        return self.letters[np.minimum(codes, np.int64(len(self.letters) - 1))]

    def step(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The next nodes, -1 where there is none."""
        key = node.astype(np.int64) * self.width + letter
        if self.table is not None:
            return self.table[key]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.nodes[place], -1)

    def longest(self, letters: np.ndarray, at: np.ndarray, root: int) -> tuple[np.ndarray, np.ndarray]:
        """Id and length of the longest token at each of the places; length 0 where there is none. A 0 ends words."""
        ids, size = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        index, node, depth = np.arange(len(at)), np.full(len(at), root), 0
        while len(index):
            node = self.step(node, letters[at + depth])
            on = np.flatnonzero(node >= 0)
            node, at, index = node[on], at[on], index[on]
            depth += 1
            found = self.ids[node]
            hit = np.flatnonzero(found != self.NONE)
            ids[index[hit]], size[index[hit]] = found[hit], depth
        return ids, size


class Matcher:
    """Greedy longest matches. A code is (id, f, n): a token, the character of the word it begins at, how many it takes."""

    def __init__(self, heads: dict[str, int], tails: dict[str, int], whole: dict[str, int], unk: int, unk_name: str, max_chars: int):
        self.given = heads, tails, whole, unk, unk_name, max_chars
        self.heads, self.tails, self.whole, self.unk, self.unk_name, self.max_chars = self.given
        self.key = os.urandom(16)

    def __reduce__(self):
        return _opened, (self.key, *self.given)

    @cached_property
    def trie(self) -> Trie:
        return Trie(self.heads, self.tails)

    def codes(self, words: pa.Array) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """How many codes each word has, and the codes of all words in turn.

        A word that is too long, or has a rest that no piece matches, is one unknown token; so is one that is empty.
        """
        texts = pc.fill_null(words, "")
        size = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        begin = np.cumsum(size) - size + np.arange(len(size))  # a 0 stands behind each word
        letters = np.zeros(size.sum() + len(size), dtype=np.int64)
        letters[np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)] = self.trie.numbered(characters(texts))
        kept = pc.fill_null(pc.index_in(words, value_set=pa.array(list(self.whole), words.type)), -1).to_numpy(zero_copy_only=False)
        single = np.append(np.array(list(self.whole.values()), dtype=np.int64), self.unk)[kept]  # the id of a word that is one token
        alone = (kept >= 0) | (size == 0) | (size > self.max_chars)
        live, at, parts, root = np.flatnonzero(~alone), begin.copy(), [], 0
        while len(live):
            ids, n = self.trie.longest(letters, at[live], root)
            alone[live[n == 0]] = True
            live, ids, n = live[n > 0], ids[n > 0], n[n > 0]
            parts.append((live, ids, at[live] - begin[live], n))
            at[live] += n
            live = live[at[live] < begin[live] + size[live]]
            root = 1
        parts = [[column[~alone[part[0]]] for column in part] for part in parts]
        one = np.flatnonzero(alone)
        parts.append([one, single[one], np.zeros(len(one), dtype=np.int64), size[one]])
        word, *codes = (np.concatenate(column) for column in zip(*parts, strict=True))
        order = np.argsort(word, kind="stable")
        return np.bincount(word, minlength=len(size)), tuple(c[order].astype(np.int32) for c in codes)

    def __call__(self, words: pa.Array) -> Coded:
        return Coded(self, words)


_open: dict[bytes, Matcher] = {}


def _opened(key: bytes, *given) -> Matcher:
    """A worker that has the matcher from a task before goes on with it; it keeps one."""
    if key not in _open:
        _open.clear()
        _open[key] = Matcher(*given)
        _open[key].key = key
    return _open[key]


class Coded:
    """The codes of a flat array of words: ``n`` codes a word, and columns with an element for each code."""

    def __init__(self, matcher: Matcher, words: pa.Array):
        table = words.dictionary_encode(null_encoding="encode")
        self.matcher, self.distinct = matcher, table.dictionary
        self.count, self.codes = matcher.codes(table.dictionary)
        self.at = table.indices.to_numpy()
        self.n = self.count[self.at]
        self.ends = np.concatenate([[0], np.cumsum(self.n)])
        start = np.cumsum(self.count) - self.count
        self.place = np.arange(self.ends[-1]) + np.repeat(start[self.at] - self.ends[:-1], self.n)
        self.ids = self.codes[0][self.place]

    @cached_property
    def piece(self) -> np.ndarray:
        return np.arange(self.ends[-1]) - np.repeat(self.ends[:-1], self.n)

    @cached_property
    def word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at)), self.n)

    @cached_property
    def f(self) -> np.ndarray:
        return self.codes[1][self.place]

    @cached_property
    def size(self) -> np.ndarray:
        return self.codes[2][self.place]

    def tokens(self, chosen: np.ndarray | slice = slice(None)) -> pa.Array:
        """The text of each code's token, or of those chosen."""
        used, place = np.unique(self.place[chosen], return_inverse=True)
        word = np.searchsorted(np.cumsum(self.count), used, side="right")
        words = self.distinct.take(pa.array(word)).to_pylist()
        texts = [
            self.matcher.unk_name if i == self.matcher.unk else ("##" if f else "") + (word or "")[f : f + n]
            for i, f, n, word in zip(*(c[used].tolist() for c in self.codes), words, strict=True)
        ]
        return pa.array(texts, pa.string()).take(pa.array(place))


def lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def bounds(lists: pa.Array) -> np.ndarray:
    """Where each list begins among all elements, and the end of the last."""
    return np.concatenate([[0], np.cumsum(lengths(lists))])


def listed(ends: np.ndarray, values: pa.Array, like: pa.Array | None = None) -> pa.Array:
    """Lists of ``values``, null where ``like`` is."""
    mask = like.is_null() if like is not None and like.null_count else None
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=mask)


def row_ids(matcher: Matcher, words: pa.Array) -> pa.Array:
    """array<string> to array<int>: the ids of all words of a row, one behind the other."""
    coded = matcher(words.flatten())
    return listed(coded.ends[bounds(words)], pa.array(coded.ids), words)


def row_codes(matcher: Matcher, words: pa.Array) -> pa.Array:
    """array<string> to array<array<struct<id, f, n>>>: the codes of each word."""
    coded = matcher(words.flatten())
    code = pa.StructArray.from_arrays([pa.array(c) for c in (coded.ids, coded.f, coded.size)], ["id", "f", "n"])
    return listed(bounds(words), listed(coded.ends, code), words)


class TokenNames:
    """The texts of ids, as sorted arrays. Tokens that share an id stand side by side."""

    def __init__(self, tokens: list[tuple[int, str]]):
        named: dict[int, list[str]] = {}
        for i, token in sorted(tokens):
            named.setdefault(i, []).append(token)
        self.ids = np.array(list(named), dtype=np.int64)
        self.texts = pa.array([" ".join(t) for t in named.values()], pa.string())


def row_text(names: TokenNames, lists: pa.Array) -> pa.Array:
    """array<bigint> to string: the tokens of a row's ids with a blank between, those without a text left out."""
    flat = lists.flatten()
    ids = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    place = np.minimum(np.searchsorted(names.ids, ids), max(len(names.ids) - 1, 0))
    known = (names.ids[place] == ids if len(names.ids) else np.zeros(len(ids), dtype=bool)) & flat.is_valid().to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(known)])[bounds(lists)]
    return pc.binary_join(listed(ends, names.texts.take(pa.array(place[known]))), " ")


def _placed(matcher: Matcher, words: pa.Array, at: pa.Array) -> tuple[Coded, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The codes of all words, where each row's begin, each code's word in its row, and its first character and the
    one behind its last.

    ``words`` have the blanks before them, and their places follow; where ``at`` is not null, they are bare, and it
    holds the places of all of their characters.
    """
    first, flat = bounds(words), words.flatten()
    row = np.repeat(np.arange(len(words)), lengths(words))
    if at.null_count == len(at):
        bare = pc.utf8_ltrim(flat, characters=" ")
    else:
        plain = at.is_null().to_numpy(zero_copy_only=False)[row]
        bare = pc.if_else(pa.array(plain), pc.utf8_ltrim(flat, characters=" "), flat)
    coded = matcher(bare)
    size = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(size)])
    base = upto[1:] - pc.utf8_length(bare).to_numpy(zero_copy_only=False) - upto[first[:-1]][row]
    word_no = coded.word - first[:-1][row[coded.word]]
    begin = base[coded.word] + coded.f
    last = begin + coded.size - 1
    given = np.empty(0, np.int64) if at.null_count == len(at) else np.flatnonzero(~plain[coded.word])
    if len(given):
        places, own = at.flatten(), bounds(at)
        where = bounds(places)[own[row[coded.word[given]]] + word_no[given]]
        chars = places.flatten().to_numpy(zero_copy_only=False)
        begin[given], last[given] = chars[where + coded.f[given]], chars[where + coded.f[given] + coded.size[given] - 1]
    return coded, coded.ends[first], word_no, begin, last + 1


def row_tokens(matcher: Matcher, words: pa.Array, at: pa.Array) -> pa.Array:
    """To array<struct<word_no, piece_no, token, id, s, e>>: the tokens of each row's words and their characters."""
    coded, ends, word_no, begin, end = _placed(matcher, words, at)
    columns = [
        pa.array(word_no, pa.int32()), pa.array(coded.piece, pa.int32()), coded.tokens(), pa.array(coded.ids),
        pa.array(begin, pa.int32()), pa.array(end, pa.int32()),
    ]
    made = pa.StructArray.from_arrays(columns, ["word_no", "piece_no", "token", "id", "s", "e"])
    return listed(ends, made, words)


def row_spans(matcher: Matcher, words: pa.Array, at: pa.Array) -> pa.Array:
    """To struct<ids, s, e>, of array<int> each: ids of the tokens of each row's words and their characters."""
    coded, ends, _, begin, end = _placed(matcher, words, at)
    made = [listed(ends, pa.array(x, pa.int32())) for x in (coded.ids, begin, end)]
    return pa.StructArray.from_arrays(made, ["ids", "s", "e"], mask=words.is_null())


def row_covering(matcher: Matcher, words: pa.Array, at: pa.Array, asked: pa.Array) -> pa.Array:
    """To array<struct<at, word_no, piece_no, token, s, e>>: for each asked character that a token of the row covers,
    that token. A row's tokens stand in the order of their characters and do not overlap."""
    coded, ends, word_no, begin, end = _placed(matcher, words, at)
    row = np.repeat(np.arange(len(asked)), lengths(asked))
    char = asked.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    # One order for all rows: a row's tokens and asked characters lie in a stretch of its own.
    width = int(end.max(initial=0)) + 2
    first = np.repeat(np.arange(len(words)), np.diff(ends)) * width + begin
    token = np.searchsorted(first, row * width + np.clip(char, -1, width - 1), side="right") - 1
    on = np.flatnonzero((token >= ends[row]) & (token < ends[row + 1]))
    on = on[(begin[token[on]] <= char[on]) & (char[on] < end[token[on]])]
    hit = token[on]
    columns = [
        pa.array(char[on]), pa.array(word_no[hit], pa.int32()), pa.array(coded.piece[hit], pa.int32()), coded.tokens(hit),
        pa.array(begin[hit], pa.int32()), pa.array(end[hit], pa.int32()),
    ]
    made = pa.StructArray.from_arrays(columns, ["at", "word_no", "piece_no", "token", "s", "e"])
    return listed(np.searchsorted(row[on], np.arange(len(asked) + 1)), made)


def row_labels(matcher: Matcher, words: pa.Array, mark: pa.Array, tags: pa.Array, ignored: int | None) -> pa.Array:
    """Words with ``mark`` ahead of those of each token, and the tokens' tags, to struct<ids, labels>.

    The first piece of a token has its tag, a later one too, or ``ignored``.
    """
    flat, ends = words.flatten(), bounds(words)
    row = np.repeat(np.arange(len(words)), lengths(words))
    is_mark = pc.fill_null(pc.equal(flat, mark.take(pa.array(row))), False).to_numpy(zero_copy_only=False)
    coded = matcher(pc.if_else(pa.array(is_mark), MARK, flat))
    marks = np.cumsum(is_mark)
    ahead = np.concatenate([[0], marks])[ends[:-1]]
    token = marks - ahead[row] - 1  # the number of a word's token in its row
    kept = ~is_mark[coded.word]
    word = coded.word[kept]
    own = lengths(tags)[row[word]]
    place = bounds(tags)[row[word]] + token[word]
    values = tags.flatten().take(pa.array(place, mask=token[word] >= own))
    if ignored is not None:
        first = is_mark[word - 1] & (coded.piece[kept] == 0)
        values = pc.if_else(pa.array(first), values, pa.scalar(ignored, pa.int32()))
    cut = np.concatenate([[0], np.cumsum(kept)])[coded.ends[ends]]
    made = [listed(cut, pa.array(coded.ids[kept])), listed(cut, values.cast(pa.int32()))]
    return pa.StructArray.from_arrays(made, ["ids", "labels"], mask=words.is_null())
