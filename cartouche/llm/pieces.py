"""SentencePiece encoding and decoding by a batched numpy Viterbi.

A text becomes characters with a space mark for each space and one in front; it falls into words, each with the mark
before it. Distinct words of a batch are grouped by length, and all words of a length advance together: for each end
position, hashes of the substrings that end there probe the sorted hashes of the pieces, and the best allowed piece
is stored as a backpointer. Which transition is allowed follows the model: its vocabulary was made by merging pairs, and
two neighbouring pieces stand in an encoding exactly if merging their joint text would not cross their boundary. That is
checked by undoing merges on both sides, again for all words at once. New words of several slices of text are encoded
together, so that numpy's calls, of which a word length needs about as many as it has spans, are few for many words. Exactly one allowed piece ends at each position, so
the result is the encoding of the model's own library. Characters outside the vocabulary become byte pieces.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cartouche.llm.words import give_back, mix, slices

MARK = 0x2581
SPACE = 0x20
MOST_CACHED = 1 << 20
CELLS_AT_ONCE = 400_000  # characters of equally long words that advance together
BATCH, SLICE = 8 << 20, 1 << 19  # bytes of text whose new words are learned together, and that are encoded together
FILTER_BITS = 20
RADIX = np.uint64(0xC2B2AE3D27D4EB4F)
FAR = np.int64(1) << 40


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, RADIX, np.uint64), np.full(n, np.uint64(pow(int(RADIX), -1, 1 << 64)), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def char_values(chars: np.ndarray) -> np.ndarray:
    return mix(chars.astype(np.uint64) + np.uint64(0x51ED27)) | np.uint64(1)


def span_hashes(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each span of characters."""
    up, down = powers(len(chars) + 1)
    sums = np.r_[np.uint64(0), np.cumsum(char_values(chars) * up[:-1], dtype=np.uint64)]
    return (sums[ends] - sums[starts]) * down[starts]


def missing(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Positions of the keys that a sorted array lacks."""
    if not len(known):
        return np.arange(len(keys))
    return np.flatnonzero(known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] != keys)


class Pieces:
    """The vocabulary by hash, with each piece's merge order and the two pieces it was merged from."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = np.zeros(256, np.int32)
        plain = []
        for i, text in enumerate(self.text):
            if model.is_byte(i):
                self.byte_ids[int(text[3:5], 16)] = i
            elif not model.is_control(i) and not model.is_unknown(i):
                plain.append(i)
        self.runs = {len(self.text[i]): i for i in plain if set(self.text[i]) == {chr(MARK)}}
        inner = [i for i in plain if chr(MARK) in self.text[i][1:] and len(self.text[i]) not in self.runs]
        if inner:
            raise ValueError("a piece spans words")
        words = [i for i in plain if i not in self.runs.values() or len(self.text[i]) == 1]
        self.id_of = {self.text[i]: i for i in words}
        self.longest = max(len(self.text[i]) for i in words)
        order = sorted((i for i in words if len(self.text[i]) > 1), key=lambda i: -model.get_score(i))
        self.rank = np.full(size + 1, -1, np.int64)  # the last stands for a character outside the vocabulary
        self.rank[order] = np.arange(len(order))
        self.length = np.array([*map(len, self.text), 1], np.int64)
        self.left, self.right = np.arange(size + 1), np.arange(size + 1)
        self.unknown = size
        for i in order:
            split = self.last_merge(self.text[i])
            if split is None:  # no merge leads to it, so it never stands in an encoding
                del self.id_of[self.text[i]]
            else:
                self.left[i], self.right[i] = split
        ids = np.array(list(self.id_of.values()))
        chars = np.frombuffer("".join(self.text[i] for i in ids).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(self.length[ids])
        hashes = span_hashes(chars, ends - self.length[ids], ends)
        self.hash = np.zeros(size + 1, np.uint64)
        self.hash[ids] = hashes
        by_hash = np.argsort(hashes)
        self.keys, self.key_ids = hashes[by_hash], ids[by_hash]
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[hashes >> np.uint64(64 - FILTER_BITS)] = True
        self.up = powers(self.longest + 1)[0]
        bare = [b"" if model.is_control(i) else bytes([int(t[3:5], 16)]) if model.is_byte(i) else t.replace(chr(MARK), " ").encode() for i, t in enumerate(self.text)]
        self.byte_size = np.array([len(b) for b in bare], np.int64)
        self.byte_at = np.cumsum(self.byte_size) - self.byte_size
        self.bytes = np.frombuffer(b"".join(bare), np.uint8)
        self.forget()

    def last_merge(self, text: str) -> tuple[int, int] | None:
        """The two pieces whose merge completes a piece."""
        symbols, best = list(text), None
        while len(symbols) > 1:
            ranks = [(self.rank[i], k) for k in range(len(symbols) - 1) if (i := self.id_of.get(symbols[k] + symbols[k + 1])) is not None]
            if not ranks:
                return None
            k = min(ranks)[1]
            best = symbols[k], symbols[k + 1]
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
        return tuple(self.id_of.get(s, self.unknown) for s in best)

    def forget(self) -> None:
        self.word_keys, self.word_at, self.word_size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.word_ids = np.zeros(0, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece of each hash, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        some = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - FILTER_BITS)])
        at = np.minimum(np.searchsorted(self.keys, hashes[some]), len(self.keys) - 1)
        hit = self.keys[at] == hashes[some]
        out[some[hit]] = self.key_ids[at[hit]]
        return out

    def allowed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each two neighbouring pieces stay apart: undo the later of their merges and look for an earlier one across."""
        ok = np.ones(len(a), bool)
        live = np.flatnonzero((a != self.unknown) & (b != self.unknown))
        a, b = a[live].copy(), b[live].copy()
        limit = np.full(len(live), FAR)
        while len(live):
            joint = np.full(len(live), -1, np.int64)
            short = np.flatnonzero(self.length[a] + self.length[b] <= self.longest)
            joint[short] = self.find(self.hash[a[short]] + self.up[self.length[a[short]]] * self.hash[b[short]])
            crosses = (joint >= 0) & (self.rank[joint] < limit)
            ok[live[crosses]] = False
            a_leaf, b_leaf = self.right[a] == a, self.left[b] == b
            open_a = ~a_leaf & ((self.rank[a] > self.rank[b]) | b_leaf)
            open_b = ~open_a & ~b_leaf
            limit = np.where(open_a, self.rank[a], self.rank[b] + 1)
            a, b = np.where(open_a, self.right[a], a), np.where(open_b, self.left[b], b)
            going = ~crosses & (open_a | open_b)
            live, a, b, limit = live[going], a[going], b[going], limit[going]
        return ok

    def viterbi(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words of one length, one word a row: all pieces in order, and how many each word has."""
        words, n = chars.shape
        up, down = powers(n + 1)
        sums = np.zeros((words, n + 1), np.uint64)
        np.cumsum(char_values(chars) * up[:-1], axis=1, dtype=np.uint64, out=sums[:, 1:])
        back = np.full((words, n + 1), self.unknown, np.int32)
        for end in range(1, n + 1):
            unsettled = np.arange(words)
            for size in range(min(end, self.longest), 0, -1):
                start = end - size
                piece = self.find((sums[unsettled, end] - sums[unsettled, start]) * down[start])
                if size == 1:
                    piece[piece < 0] = self.unknown
                some = np.flatnonzero(piece >= 0)
                if start:
                    some = some[self.allowed(back[unsettled[some], start], piece[some])]
                if len(some):
                    back[unsettled[some], end] = piece[some]
                    unsettled = np.delete(unsettled, some)
                if not len(unsettled):
                    break
        out, at = np.full((words, n), -1, np.int32), np.full(words, n)
        for column in range(n - 1, -1, -1):
            going = np.flatnonzero(at > 0)
            if not len(going):
                break
            out[going, column] = back[going, at[going]]
            at[going] -= self.length[out[going, column]]
        kept = out >= 0
        return out[kept], kept.sum(1)

    def learn(self, keys: np.ndarray, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode words and remember them."""
        sizes = ends - starts
        parts, found, lengths = [], [], []
        for n in np.unique(sizes).tolist():
            group = np.flatnonzero(sizes == n)
            most = max(CELLS_AT_ONCE // n, 1)
            for at in range(0, len(group), most):
                part = group[at:at + most]
                letters = chars[starts[part][:, None] + np.arange(n)]
                pieces, counts = self.viterbi(letters)
                ids, counts = self.with_bytes(letters, pieces, counts)
                parts.append(part)
                found.append(ids)
                lengths.append(counts)
        size = np.concatenate(lengths)
        at = len(self.word_ids) + np.cumsum(size) - size
        self.word_ids = np.concatenate([self.word_ids, *found])
        fresh = keys[np.concatenate(parts)]
        order = np.argsort(fresh)
        # two sorted runs, which a stable sort merges
        both = np.argsort(merged := np.r_[self.word_keys, fresh[order]], kind="stable")
        self.word_keys = merged[both]
        self.word_at, self.word_size = np.r_[self.word_at, at[order]][both], np.r_[self.word_size, size[order]][both]

    def with_bytes(self, letters: np.ndarray, pieces: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, with the UTF-8 bytes of each character outside the vocabulary."""
        odd = np.flatnonzero(pieces == self.unknown)
        if not len(odd):
            return pieces.astype(np.int32), counts
        where = np.cumsum(self.length[pieces]) - self.length[pieces]
        raw = [chr(c).encode() for c in letters.ravel()[where[odd]]]
        size = np.ones(len(pieces), np.int64)
        size[odd] = [len(r) for r in raw]
        out = np.repeat(pieces, size)
        first = np.cumsum(size) - size
        for at, r in zip(first[odd].tolist(), raw):
            out[at:at + len(r)] = self.byte_ids[list(r)]
        row = np.repeat(np.arange(len(counts)), counts)
        return out.astype(np.int32), np.bincount(row, size, len(counts)).astype(np.int64)

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Characters of all texts, each text's edges, the words' starts and ends, and the space marks before each word."""
        marked = [chr(MARK) + t if t else "" for t in texts]
        chars = np.frombuffer("".join(marked).replace(" ", chr(MARK)).encode("utf-32-le"), np.uint32)
        edge = np.cumsum([0, *map(len, marked)])
        is_mark = chars == MARK
        # a word starts at the last mark of a run; the marks before it are a run of their own
        following = np.r_[is_mark[1:], False]
        following[edge[1:][edge[1:] > 0] - 1] = False
        begins = is_mark & ~following
        starts = np.flatnonzero(begins)
        opens = is_mark.copy()
        opens[1:] &= ~is_mark[:-1]
        opens[edge[:-1][np.diff(edge) > 0]] = True
        open_at = np.flatnonzero(opens)  # one for each word: where its run begins
        ends = np.r_[open_at[1:], len(chars)][:len(starts)]
        return chars, edge, starts, ends, starts - open_at

    def prepare(self, parts: list[list[str]]) -> None:
        """Learn the new words of all parts at once."""
        keys, letters, sizes = [self.word_keys[:0]], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for texts in parts:
            chars, _, starts, ends, _ = self.cut(texts)
            found, first = np.unique(span_hashes(chars, starts, ends), return_index=True)
            fresh = missing(found, self.word_keys)
            starts, size = starts[first[fresh]], (ends - starts)[first[fresh]]
            keys.append(found[fresh])
            sizes.append(size)
            letters.append(chars[np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))])
        sizes = np.concatenate(sizes)
        ends = np.cumsum(sizes)
        keys, first = np.unique(np.concatenate(keys), return_index=True)
        if len(self.word_keys) + len(keys) > MOST_CACHED:
            self.forget()  # words met before are learned again where they occur
        if len(keys):
            self.learn(keys, np.concatenate(letters), (ends - sizes)[first], ends[first])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each."""
        chars, edge, starts, ends, run = self.cut(texts)
        keys, first, where = np.unique(span_hashes(chars, starts, ends), return_index=True, return_inverse=True)
        fresh = missing(keys, self.word_keys)
        if len(self.word_keys) + len(fresh) > MOST_CACHED:
            self.forget()
            fresh = np.arange(len(keys))
        if len(fresh):
            self.learn(keys[fresh], chars, starts[first[fresh]], ends[first[fresh]])
        known = np.searchsorted(self.word_keys, keys)[where] if len(keys) else where
        at, size = self.word_at[known], self.word_size[known]
        # a mark that stays alone joins the marks before it
        lone = (run > 0) & (self.word_ids[at] == self.id_of.get(chr(MARK), -1)) if len(at) else run > 0
        run, at, size = run + lone, at + lone, size - lone
        most = max(self.runs, default=1)
        blocks = -(-run // most)
        total = blocks + size
        head = np.cumsum(total) - total
        out = np.empty(int(total.sum()), np.int32)
        out[np.repeat(head + blocks - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))] = self.word_ids[
            np.repeat(at - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        for i in np.flatnonzero(blocks):
            rest = int(run[i] - (blocks[i] - 1) * most)
            out[head[i]:head[i] + blocks[i]] = [self.runs[most]] * int(blocks[i] - 1) + [self.runs[rest]]
        per_row = np.searchsorted(starts, edge[1:]) - np.searchsorted(starts, edge[:-1])
        ends_at = np.r_[0, np.cumsum(total)][np.r_[0, np.cumsum(per_row)]]
        return out, np.diff(ends_at)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of id sequences; bytes that are no UTF-8 become U+FFFD."""
        size = self.byte_size[ids]
        total = np.r_[0, np.cumsum(size)]
        raw = self.bytes[np.repeat(self.byte_at[ids] - total[:-1], size) + np.arange(int(total[-1]))].tobytes()
        cut = total[np.r_[0, np.cumsum(counts)]].tolist()
        return [raw[a + (a < b and raw[a] == SPACE):b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:])]


@lru_cache(maxsize=1)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def encode_batches(batches, at: int, model: str):
    """Every slice of text with its ids, the number of ids of each row, and which rows are null."""
    for batch in slices(batches, "text", BATCH):
        parts = list(slices([batch], "text", SLICE))
        pieces = pieces_of(model)
        pieces.prepare([[t or "" for t in part.column(at).to_pylist()] for part in parts])
        for part in parts:
            texts = part.column(at).to_pylist()
            ids, counts = pieces.encode([t or "" for t in texts])
            yield part, ids, counts, np.array([t is None for t in texts])
    give_back()


def id_lists(ids: np.ndarray, counts: np.ndarray, null: np.ndarray) -> pa.ListArray:
    offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32), mask=np.r_[null, False])
    return pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))


def encode_texts(documents: DataFrame, model: str) -> DataFrame:
    """All columns with ``ids`` (array of int); an input column of that name is replaced.

    A null text has null ids, an empty one none. A space mark (U+2581) in a text counts as a space, as in the model.
    Repeated rows get equal results. An empty table gives an empty result.
    """
    own = [c for c in documents.columns if c != "ids"]
    documents = documents.select([f"`{c}`" for c in own])
    at = own.index("text")

    def run(batches):
        for part, ids, counts, null in encode_batches(batches, at, model):
            yield pa.RecordBatch.from_arrays([*part.columns, id_lists(ids, counts, null)], names=[*own, "ids"])

    return documents.mapInArrow(run, T.StructType([*documents.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def round_trip(documents: DataFrame, model: str) -> DataFrame:
    """All columns but ``text`` with ``ids`` and ``decoded``: ``decode_ids`` of ``encode_texts`` in one Python step."""
    kept = [c for c in documents.columns if c not in ("ids", "decoded")]
    documents = documents.select([f"`{c}`" for c in kept])
    at, own = kept.index("text"), [c for c in kept if c != "text"]

    def run(batches):
        for part, ids, counts, null in encode_batches(batches, at, model):
            texts = pa.array(pieces_of(model).decode(ids, counts), pa.string(), mask=null)
            yield pa.RecordBatch.from_arrays([*[part.column(kept.index(c)) for c in own], id_lists(ids, counts, null), texts], names=[*own, "ids", "decoded"])

    more = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return documents.mapInArrow(run, T.StructType([*[f for f in documents.schema.fields if f.name != "text"], *more]))


def decode_ids(encoded: DataFrame, model: str) -> DataFrame:
    """All columns with ``decoded``, the text of ``ids``; null where ``ids`` is null. Ids outside the vocabulary raise an error."""
    own = [c for c in encoded.columns if c != "decoded"]
    encoded = encoded.select([f"`{c}`" for c in own])
    at = own.index("ids")

    def run(batches):
        for batch in batches:
            column = batch.column(at)
            lengths = column.value_lengths()
            counts = np.asarray(lengths.fill_null(0)).astype(np.int64)
            texts = pieces_of(model).decode(np.asarray(column.flatten()), counts)
            missing = np.asarray(column.is_null())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string(), mask=missing)], names=[*own, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))
