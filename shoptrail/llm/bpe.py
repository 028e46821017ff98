"""Byte-pair encoding and decoding: speculate, verify, repair.

A greedy longest match proposes tokens for every distinct word. A proposal is the true encoding if and only if each of its
tokens can arise from merges and each pair of neighbours is compatible, that is, encoding the two tokens' bytes together
gives the two tokens back; that is tested for all pairs of all words at once in numpy. Only words that fail are merged
exactly, with a heap, in O(n log n) for a word of n bytes.

Texts are split at single spaces between two characters that aren't white space, which are word borders under the pattern;
such pieces are remembered, so frequent ones are encoded once for each task. Texts with other spacing go through the pattern.

Null and empty texts give an empty list of ids. Long texts are never cut. Repeated rows are encoded alike. Other columns are
handed on as they are; the output column must have a name of its own. Decoding gives null lists the empty text, replaces bytes
that aren't UTF-8 by U+FFFD and refuses ids outside the vocabulary.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import Shipped

# fixed values: the split pattern of this vocabulary family, with Unicode's White_Space written out
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _SPACE + r"\p{L}\p{N}]+|["
    + _SPACE + r"]+(?![^" + _SPACE + r"])|[" + _SPACE + "]+"
)
REMEMBERED = 120_000  # pieces a task keeps before it starts afresh; changes nothing but time
_LONG = 256  # bytes of a word from which exact merging takes the heap
_NONE = np.int64(1) << 40


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next letter from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class Pairs:
    """A hash table from pairs of numbers to numbers, for whole arrays at once."""

    def __init__(self, pairs: dict[tuple[int, int], int]) -> None:
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, _NONE, np.int64)
        keys = np.fromiter((a << 20 | b for a, b in pairs), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int64, len(pairs))
        at = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] < 0)
            slots, chosen = np.unique(at[free], return_index=True)
            taken = free[chosen]
            self.keys[slots], self.values[slots] = keys[taken], values[taken]
            rest = np.ones(len(keys), bool)
            rest[taken] = False
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The value of each pair, or a number above all values."""
        keys = a << 20 | b
        at = self._slot(keys)
        seen = self.keys[at]
        result = self.values[at]
        result[seen != keys] = _NONE
        rest = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & self.mask
            seen = self.keys[at[rest]]
            hit = seen == keys[rest]
            result[rest[hit]] = self.values[at[rest[hit]]]
            rest = rest[~hit & (seen >= 0)]
        return result


class Vocabulary:
    """Tables of a byte-level BPE: nodes 0-255 are bytes, node 256 + i is what merge i makes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        names = [""] * 256
        for letter, byte in letters.items():
            names[byte] = letter
        left, right, nodes, texts = list(range(256)), list(range(256)), {n: i for i, n in enumerate(names)}, names
        self.merges: dict[tuple[int, int], int] = {}
        for merge in spec["model"]["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            if a + b in nodes:
                raise ValueError(f"two merges make {a + b!r}")
            self.merges[nodes[a], nodes[b]] = nodes[a + b] = len(texts)
            left.append(nodes[a])
            right.append(nodes[b])
            texts.append(a + b)
        self.left, self.right = np.array(left), np.array(right)
        self.id_of_node = np.array([ids[t] for t in texts], np.int32)
        spelled = [bytes(letters[c] for c in t) for t in texts]
        self.pairs = Pairs(self.merges)
        self.whole = self._whole()
        step: dict[tuple[int, int], int] = {}
        self.token_at = [-1]  # of the places of a prefix tree: the token that ends there
        for node, word in enumerate(spelled):
            at = 0
            for byte in word:
                at = step.setdefault((at, byte), len(self.token_at))
                if at == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[at] = node
        self.steps, self.token_at = Pairs(step), np.array(self.token_at)
        size = max([*ids.values(), *self.special.values()]) + 1
        by_id: list[bytes | None] = [None] * size
        for node, i in enumerate(self.id_of_node):
            by_id[i] = spelled[node]
        for text, i in self.special.items():
            by_id[i] = text.encode()
        self.known = np.array([x is not None for x in by_id])
        self.lengths = np.array([len(x or b"") for x in by_id], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.flat = np.frombuffer(b"".join(x or b"" for x in by_id), np.uint8)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """True where no merge across the border comes before the merges that build ``a`` and ``b``.

        The later of the two nodes is undone step by step; a merge across the border would have to come before what was undone.
        """
        result = np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), _NONE) if limit is None else limit.astype(np.int64)
        while len(at):
            broken = self.pairs.find(a, b) < limit
            result[at[broken]] = False
            stuck_left, stuck_right = a < 256, b < 256
            left_next = ((a > b) & ~stuck_left) | (stuck_right & ~stuck_left)
            limit = np.where(left_next, a, b + 1)
            a, b = np.where(left_next, self.right[a], a), np.where(left_next, b, self.left[b])
            on = ~broken & ~(stuck_left & stuck_right)
            at, a, b, limit = at[on], a[on], b[on], limit[on]
        return result

    def _whole(self) -> np.ndarray:
        """Nodes whose own bytes encode to them alone."""
        made = np.arange(256, len(self.left))
        fits = np.ones(len(self.left), bool)
        fits[256:] = self.compatible(self.left[made], self.right[made], made)
        for node in made:  # parts come before what they make
            fits[node] &= fits[self.left[node]] and fits[self.right[node]]
        return fits

    def propose(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all words side by side: nodes one word after another, and their number for each word."""
        counts = np.zeros(len(starts), np.int64)
        word, at = np.arange(len(starts)), starts.copy()
        end = starts + sizes
        place, token, token_end = np.zeros(len(word), np.int64), np.full(len(word), -1), at.copy()
        words, orders, nodes = [], [], []
        while len(word):
            inside = at < end
            following = self.steps.find(place, data[np.minimum(at, len(data) - 1)].astype(np.int64))
            on = inside & (following < _NONE)
            place = np.where(on, following, 0)
            at = np.where(on, at + 1, at)
            ends_here = np.where(on, self.token_at[place], -1)
            token, token_end = np.where(ends_here >= 0, ends_here, token), np.where(ends_here >= 0, at, token_end)
            stop = np.flatnonzero(~on)
            words.append(word[stop])
            orders.append(counts[word[stop]])
            nodes.append(token[stop])
            counts[word[stop]] += 1
            at[stop] = token_end[stop]
            left = on | (token_end < end)
            word, at, end, place, token, token_end = word[left], at[left], end[left], place[left], token[left], token_end[left]
        first = np.cumsum(counts) - counts
        found = np.empty(int(counts.sum()), np.int64)
        if words:
            found[first[np.concatenate(words)] + np.concatenate(orders)] = np.concatenate(nodes)
        return found, counts

    def merge(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact encoding of all words side by side: in each round every word does its earliest merge, the leftmost of equal ones."""
        owner, nodes = np.repeat(np.arange(len(starts)), sizes), data[gathered(starts, sizes)].astype(np.int64)
        done_owner, done_nodes = [], []
        while len(nodes):
            rank = np.full(len(nodes), _NONE)
            rank[:-1] = self.pairs.find(nodes[:-1], nodes[1:])
            rank[:-1][owner[1:] != owner[:-1]] = _NONE
            head = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            each = np.diff(np.concatenate([head, [len(nodes)]]))
            best = np.minimum.reduceat(rank, head)
            over = np.repeat(best == _NONE, each)
            hit = np.flatnonzero((rank == np.repeat(best, each)) & ~over)
            hit = hit[np.concatenate([[True], owner[hit[1:]] != owner[hit[:-1]]])] if len(hit) else hit
            done_owner.append(owner[over])
            done_nodes.append(nodes[over])
            nodes[hit] = rank[hit]
            over[hit + 1] = True
            owner, nodes = owner[~over], nodes[~over]
        if not done_owner:
            return np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
        owner, nodes = np.concatenate(done_owner), np.concatenate(done_nodes)
        return nodes[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(starts))

    def merge_long(self, word: bytes) -> list[int]:
        """As ``merge`` for one long word, with a heap."""
        nodes, n = list(word), len(word)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(m, i, nodes[i], nodes[i + 1]) for i in range(n - 1) if (m := self.merges.get((nodes[i], nodes[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            made, i, a, b = heapq.heappop(heap)
            j = after[i]
            if nodes[i] != a or j < 0 or nodes[j] != b:
                continue
            nodes[i], nodes[j], after[i] = made, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (m := self.merges.get((nodes[x], nodes[y]))) is not None:
                    heapq.heappush(heap, (m, x, nodes[x], nodes[y]))
        return [x for x in nodes if x >= 0]

    def encode_words(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Nodes of distinct, non-empty words one after another, and their number for each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        nodes, counts = self.propose(data, starts, sizes)
        owner = np.repeat(np.arange(len(words)), counts)
        fails = np.zeros(len(words), bool)
        fails[owner[~self.whole[nodes]]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        keys, back = np.unique(nodes[inner] << 20 | nodes[inner + 1], return_inverse=True)
        fits = self.compatible(keys >> 20, keys & ((1 << 20) - 1))[back]
        fails[owner[inner[~fits]]] = True
        long, short = np.flatnonzero(fails & (sizes > _LONG)), np.flatnonzero(fails & (sizes <= _LONG))
        repaired, each = self.merge(data, starts[short], sizes[short])
        by_heap = [np.array(self.merge_long(words[k]), np.int64) for k in long]
        source = np.concatenate([nodes, repaired, *by_heap])
        first = np.cumsum(counts) - counts
        first[short] = len(nodes) + np.cumsum(each) - each
        counts[short] = each
        counts[long] = [len(x) for x in by_heap]
        first[long] = len(nodes) + len(repaired) + np.cumsum(counts[long]) - counts[long]
        return source[gathered(first, counts)], counts


class Encoder:
    """Encodes batches of texts and remembers words and pieces; one for each task."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = PATTERN) -> None:
        import regex

        self.v = vocabulary
        self.words_of = regex.compile(pattern).findall
        self.specials = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.clear()

    def clear(self) -> None:
        self.first: dict[str, int] = {}  # pieces at the start of a text
        self.spaced: dict[str, int] = {}  # pieces after a space, without it
        self.whole: dict[str, int] = {}  # words of the pattern, as pieces
        self.piece_starts, self.piece_sizes, self.piece_words = array("q"), array("q"), array("q")
        self.words: dict[str, int] = {}
        self.fresh: list[str] = []
        self.nodes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _new(self, table: dict[str, int], key: str, words: Sequence[str]) -> int:
        code = table[key] = len(self.piece_starts)
        self.piece_starts.append(len(self.piece_words))
        self.piece_sizes.append(len(words))
        for w in words:
            number = self.words.get(w)
            if number is None:
                number = self.words[w] = len(self.words)
                self.fresh.append(w)
            self.piece_words.append(number)
        return code

    def _pattern_codes(self, text: str) -> list[int]:
        get = self.whole.get
        return [c if (c := get(w)) is not None else self._new(self.whole, w, (w,)) for w in self.words_of(text)]

    def _codes(self, text: str) -> list[int]:
        parts = text.split(" ")
        codes = list(map(self.spaced.get, parts))
        codes[0] = self.first.get(parts[0])
        for i, code in enumerate(codes):
            if code is None:
                part = parts[i]
                if not part or part[0].isspace() or part[-1].isspace():
                    return self._pattern_codes(text)
                whole = " " + part if i else part
                if part.isalpha():  # letters are one word of the pattern, and so is a lone mark after them
                    words: Sequence[str] = (whole,)
                elif part[-1] in ".,!?;:" and part[:-1].isalpha():
                    words = (whole[:-1], part[-1])
                else:
                    words = self.words_of(whole)
                codes[i] = self._new(self.spaced if i else self.first, part, words)
        return codes

    def _resolve(self) -> None:
        if self.fresh:
            nodes, counts = self.v.encode_words([w.encode() for w in self.fresh])
            self.nodes, self.counts = np.concatenate([self.nodes, nodes]), np.concatenate([self.counts, counts])
            self.fresh = []

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each text."""
        codes, raw, held = array("q"), [], []
        for text in texts:
            before = len(codes)
            if not text:
                pass
            elif self.special is not None and any(s in text for s in self.specials):
                for part in self.special.split(text):
                    if part in self.v.special:
                        raw.append((len(codes), self.v.special[part]))
                        codes.append(0)
                    elif part:
                        codes.extend(self._codes(part))
            else:
                codes.extend(self._codes(text))
            held.append(len(codes) - before)
        self._resolve()
        codes, owners = np.array(codes, np.int64), np.repeat(np.arange(len(texts)), held)
        starts, sizes = np.array(self.piece_starts, np.int64), np.array(self.piece_sizes, np.int64)
        words, counts = np.array(self.piece_words, np.int64), self.counts
        ids = self.v.id_of_node[self.nodes]
        if raw:  # a special token is a piece of one word of one id, after all others
            new = np.arange(len(raw))
            codes[[at for at, _ in raw]] = len(starts) + new
            starts, sizes = np.concatenate([starts, len(words) + new]), np.concatenate([sizes, np.ones(len(raw), np.int64)])
            words, counts = np.concatenate([words, len(counts) + new]), np.concatenate([counts, np.ones(len(raw), np.int64)])
            ids = np.concatenate([ids, np.array([i for _, i in raw], np.int32)])
        words_each = sizes[codes]
        found = words[gathered(starts[codes], words_each)]
        first, each = (np.cumsum(counts) - counts)[found], counts[found]
        totals = np.bincount(np.repeat(owners, words_each), weights=each, minlength=len(texts)).astype(np.int64)
        if len(self.piece_starts) > REMEMBERED:
            self.clear()
        return ids[gathered(first, each)], totals


def gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of all runs that begin at ``starts`` and hold ``sizes`` items."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def _in_blocks(column: pa.Array, rows: int = 512) -> Iterator[pa.Array]:
    for at in range(0, len(column), rows):
        yield column.slice(at, rows)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns of ``df``) and a column of token ids; ``path`` is a byte-level BPE tokenizer file.

    The driver reads the file; its tables go to the executors as one broadcast of a size fixed by the vocabulary.
    """
    keep = list(df.columns if keep is None else keep)
    if ids in keep:
        raise ValueError(f"column {ids} exists")
    shared = Shipped(df, Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.load())
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found, counts = encoder.encode(part.column(part.schema.names.index(text)).to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(found))
                columns = [part.column(part.schema.names.index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, lists], names=[*keep, ids])

    fields = [df.schema[c] for c in keep]
    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(run, T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """All columns of ``df`` and the text of its token ids; special tokens are written out."""
    if text in df.columns:
        raise ValueError(f"column {text} exists")
    shared = Shipped(df, Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.load()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                lists = part.column(part.schema.names.index(ids))
                offsets = lists.offsets.to_numpy()
                found = lists.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].astype(np.int64)
                if len(found) and not (found.min() >= 0 and found.max() < len(v.known) and v.known[found].all()):
                    raise ValueError("an id is not in the vocabulary")
                sizes = v.lengths[found]
                spelled = v.flat[gathered(v.starts[found], sizes)].tobytes()
                ends = np.concatenate([[0], np.cumsum(sizes)])[offsets - offsets[0]]
                texts = [spelled[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, text])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(text, T.StringType())]))
