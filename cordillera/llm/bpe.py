"""BPE encoding and decoding with a pair occurrence index.

A batch's distinct pieces lie one after another in one symbol array.  An index
maps each mergeable pair to all its positions there; active ranks are applied in
ascending order from a heap, all positions of a pair at once, and the lists of the
pairs to the left and right of each merge are updated.  Texts are cut where a lone
space (or, for vocabularies that drop white space, any white space) separates two
chunks, since no piece reaches over such a place; each distinct chunk is encoded
once for a batch.

Null texts encode like the empty text: no ids.  Special tokens written in a text
become their ids, as in the tokenizers library.  Texts of any length are encoded
whole.  Repeated rows are encoded like any others, and columns that are not asked
for are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal

#: Unicode White_Space, for use in a character class; \s of ``regex`` also takes U+001C-U+001F.
SPACE = r"\t-\r \x85\xa0  -     　"
#: The two pre-tokenisers' patterns, with White_Space spelt out for \s.
BYTE_LEVEL = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
WORD_LEVEL = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"

def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def buffers(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0, one more than strings) and bytes of an array of strings without nulls."""
    strings = strings.cast(pa.large_binary())
    if not len(strings):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = strings.buffers()
    offsets = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    body = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], body


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices starts[i], starts[i] + 1, ... of sizes[i] items, for all i in a row."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


class PairIndex:
    """The merges of one vocabulary, applied to many pieces at once."""

    def __init__(self, vocab: dict[str, int], merges: Iterable, suffix: str = ""):
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.base = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], np.int64)
        made = [vocab[a + b] for a, b in pairs]
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.left, self.right = keys // self.base, keys % self.base
        self.made = np.array(made, np.int32)
        letters = byte_alphabet()
        self.inner = np.array([vocab[x] for x in letters], np.int32)
        self.final = np.array([vocab[x + suffix] for x in letters], np.int32)
        # Ranks of pairs of single bytes; the last row and column stand for a wall.
        single = np.r_[self.inner, self.final, -1]
        self.first = self.ranks(np.repeat(single, 513), np.tile(single, 513)).reshape(513, 513).astype(np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where there is none."""
        wanted = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == wanted) & (left >= 0) & (right >= 0), self.order[at], -1)

    def encode(self, pieces: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and where each piece's ids begin (one more at the end)."""
        offsets, body = buffers(pieces)
        sizes = np.diff(offsets)
        ends = np.cumsum(sizes + 1) - 1  # a wall of -1 after each piece
        n = int(ends[-1]) + 1 if len(pieces) else 0
        raw = np.zeros(n, np.uint8)
        raw[np.arange(len(body)) + np.repeat(np.arange(len(pieces)), sizes)] = body
        symbols = self.inner[raw]
        full = sizes > 0
        symbols[ends[full] - 1] = self.final[raw[ends[full] - 1]]
        symbols[ends] = -1
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        lists: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(positions: np.ndarray, ranks: np.ndarray) -> None:
            live = ranks >= 0
            positions, ranks = positions[live], ranks[live]
            if not len(ranks):
                return
            order = np.argsort(ranks.astype(np.uint16) if len(self.keys) < 1 << 16 else ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            starts = [0, *cuts.tolist(), len(ranks)]
            for k, r in enumerate(ranks[starts[:-1]].tolist()):
                if (found := lists.get(r)) is None:
                    lists[r] = found = []
                    heapq.heappush(heap, r)
                found.append(positions[starts[k] : starts[k + 1]])

        if n > 1:
            kinds = np.where(symbols < 0, -1, raw).astype(np.int32)
            kinds[ends[full] - 1] += 256
            note(np.arange(n - 1, dtype=np.int32), self.first[kinds[:-1], kinds[1:]])
        while heap:
            rank = heapq.heappop(heap)
            found = lists.pop(rank)
            at = found[0] if len(found) == 1 else np.concatenate(found)
            left, right = self.left[rank], self.right[rank]
            at = at[symbols[at] == left]
            behind = after[at]
            live = symbols[behind] == right
            at, behind = at[live], behind[live]
            if left == right and len(at) > 1:  # a run of one symbol merges from its left end
                at = np.unique(at)
                behind = after[at]
                begins = np.flatnonzero(np.r_[True, behind[:-1] != at[1:]])
                nth = np.arange(len(at)) - np.repeat(begins, np.diff(np.r_[begins, len(at)]))
                at, behind = at[nth % 2 == 0], behind[nth % 2 == 0]
            if not len(at):
                continue
            symbols[at] = self.made[rank]
            symbols[behind] = -2
            onward, back = after[behind], before[at]
            after[at] = onward
            before[onward] = at
            beside = symbols[at]
            note(at, self.ranks(beside, symbols[onward]))
            some = back >= 0
            note(back[some], self.ranks(symbols[back[some]], symbols[after[back[some]]]))
        stays = symbols != -2
        flat = symbols[stays]
        walls = flat == -1
        bounds = np.flatnonzero(walls) - np.arange(len(pieces))
        return flat[~walls], np.r_[0, bounds]


class Codec:
    """Encoding and decoding by a vocabulary file of the tokenizers library.

    Two kinds are known: byte-level (lossless) and lower-casing words with an
    end-of-word suffix and white space dropped.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.words = bool(self.suffix)
        self.index = PairIndex(model["vocab"], model["merges"], self.suffix)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.pattern = regex.compile(WORD_LEVEL if self.words else BYTE_LEVEL)
        values = {x: b for b, x in enumerate(byte_alphabet())}
        self.bytes = [b""] * (1 + max([*model["vocab"].values(), *self.special.values()]))
        for token, i in model["vocab"].items():
            body = token.removesuffix(self.suffix) if self.suffix else token
            self.bytes[i] = bytes(values[x] for x in body) + b" " * (body != token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.decimal = [str(i) for i in range(len(self.bytes))]

    def normal(self, text: str) -> str:
        """What words are cut from. Texts that may hold special tokens are left to ``pieces``."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()

    def pieces(self, chunk: str) -> list[bytes]:
        """What the merges work on; a special token is byte 255, which no text holds, and its id."""
        out: list[bytes] = []
        for part in self.special_pattern.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                out.append(b"\xff%d" % self.special[part])
            else:
                out.extend(x.encode() for x in self.pattern.findall(self.normal(part) if self.words else part))
        return out

    def split(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The chunks' pieces in a row, and how many each has.

        Letters alone, and letters with a full stop or comma, need no pattern.
        """
        body = chunks if self.words else pc.utf8_slice_codeunits(chunks, 1)
        spaced = np.ones(len(chunks), bool) if self.words else pc.starts_with(chunks, " ").to_numpy(zero_copy_only=False)
        plain = pc.utf8_is_alpha(body).to_numpy(zero_copy_only=False) & spaced
        stem = pc.utf8_slice_codeunits(chunks, 0, -1)
        stopped = pc.utf8_is_alpha(pc.utf8_slice_codeunits(body, 0, -1)).to_numpy(zero_copy_only=False) & spaced & ~plain
        tail = pc.utf8_slice_codeunits(chunks, -1)
        stopped &= pc.is_in(tail, pa.array([".", ","], chunks.type)).to_numpy(zero_copy_only=False)
        rest = np.flatnonzero(~plain & ~stopped)
        odd = [self.pieces(c) for c in chunks.take(pa.array(rest)).to_pylist()]
        counts = np.where(stopped, 2, 1)
        counts[rest] = np.fromiter(map(len, odd), np.int64, len(odd))
        begins = np.cumsum(counts) - counts
        one, two = np.flatnonzero(plain), np.flatnonzero(stopped)
        parts = [chunks.filter(pa.array(plain)), stem.filter(pa.array(stopped)), tail.filter(pa.array(stopped)), pa.array([x for o in odd for x in o], pa.large_binary())]
        places = np.concatenate([begins[one], begins[two], begins[two] + 1, spread(begins[rest], counts[rest])])
        order = np.empty(len(places), np.int64)
        order[places] = np.arange(len(places))
        return pa.concat_arrays([x.cast(pa.large_binary()) for x in parts]).take(pa.array(order)), counts

    def encode_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks in a row, and how many each has."""
        pieces, counts = self.split(chunks)
        coded = pieces.dictionary_encode()
        ids, starts = self.index.encode(coded.dictionary)
        starts, sizes = starts[:-1], np.diff(starts)
        marked = np.flatnonzero(pc.equal(pc.binary_slice(coded.dictionary, 0, 1), pa.scalar(b"\xff", coded.dictionary.type)).to_numpy(zero_copy_only=False))
        special = [int(x[1:]) for x in coded.dictionary.take(pa.array(marked)).to_pylist()]
        starts[marked], sizes[marked] = len(ids) + np.arange(len(marked)), 1
        ids = np.r_[ids, np.array(special, np.int32)]
        codes = coded.indices.to_numpy().astype(np.int64)
        ends = np.r_[0, np.cumsum(sizes[codes])][np.r_[0, np.cumsum(counts)]]
        return ids[spread(starts[codes], sizes[codes])], np.diff(ends)

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text's begin (one more at the end). Null: no ids."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if self.words:  # white space that is not ASCII stays inside a chunk; the pattern drops it
            texts = pa.array([t if "<|" in t else self.normal(t) for t in texts.to_pylist()], pa.large_string())
            lists = pc.ascii_split_whitespace(texts)
        else:
            lists = pc.split_pattern(texts, " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        coded = lists.flatten().dictionary_encode()
        chunks, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        if not self.words:
            # Each chunk takes the space before it, but for the first of a text. Where spaces
            # stand beside other white space, a text is one chunk.
            spaces = [pc.utf8_is_space(pc.utf8_slice_codeunits(chunks, *x)).to_numpy(zero_copy_only=False) for x in ((0, 1), (-1, None))]
            odd = spaces[0] | spaces[1] | (pc.binary_length(chunks).to_numpy(zero_copy_only=False) == 0)
            begins = np.zeros(len(codes), bool)
            begins[bounds[:-1][np.diff(bounds) > 0]] = True
            where = np.repeat(np.arange(len(texts)), np.diff(bounds))
            whole = np.zeros(len(texts), bool)
            whole[where[odd[codes]]] = True
            stays, alone = ~whole[where], np.flatnonzero(whole)
            codes[begins] += len(chunks)
            chunks = pa.concat_arrays([pc.binary_join_element_wise(pa.scalar(" ", chunks.type), chunks, pa.scalar("", chunks.type)), chunks, texts.take(pa.array(alone))])
            codes, where = np.r_[codes[stays], np.arange(len(alone)) + len(chunks) - len(alone)], np.r_[where[stays], alone]
            order = np.argsort(where, kind="stable")
            codes = codes[order]
            bounds = np.r_[0, np.cumsum(np.bincount(where, minlength=len(texts)))]
            used = np.zeros(len(chunks), bool)
            used[codes] = True
            codes = (np.cumsum(used) - 1)[codes]
            chunks = chunks.filter(pa.array(used))
        flat, sizes = self.encode_chunks(chunks)
        starts = np.cumsum(sizes) - sizes
        counts = sizes[codes]
        return flat[spread(starts[codes], counts)], np.r_[0, np.cumsum(counts)][bounds]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Each text's ids."""
        ids, bounds = self.encode_array(pa.array(texts, pa.string()))
        return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of a text; in word vocabularies a word's end becomes a space."""
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each file and Python worker."""
    return Codec(path)


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Where a vocabulary file lies: in ``folder``, else where the package of public files has it."""
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


#: Texts of about so many bytes are encoded at once.
BATCH_BYTES = 8_000_000


def encoded(batches: Iterator[pa.RecordBatch], coder: Codec, text_col: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with their ids and bounds, each of a bounded number of bytes."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(text_col)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH_BYTES, "right")))
            part = batch.slice(at, end - at)
            yield part, *coder.encode_array(part.column(text_col))
            at = end


def bpe_encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """One row per document: its id and its token ids."""

    def run(batches):
        for part, ids, bounds in encoded(batches, codec(tokenizer_path(vocabulary, folder))):
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([part.column("id"), lists], ["id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(frugal(run), "id long, ids array<int>").withColumnRenamed("id", id_col)


def bpe_decode(rows: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids", folder: str | None = None) -> DataFrame:
    """One row per id list: its text; bytes that are no UTF-8 become U+FFFD. Null lists give the empty text."""

    def run(batches):
        coder = codec(tokenizer_path(vocabulary, folder))
        for batch in batches:
            texts = [coder.decode(x or []).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(frugal(run), "id long, text string").withColumnRenamed("id", id_col)


def bpe_round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Encode and decode in one pass: id, n_tokens, and digests of ids and decoded text."""
    from hashlib import sha256

    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        coder = codec(tokenizer_path(vocabulary, folder))
        decimal = coder.decimal.__getitem__
        for part, ids, bounds in encoded(batches, coder):
            out = ([], [], [])
            for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                numbers = ids[a:b].tolist()
                out[0].append(b - a)
                out[1].append(sha256(",".join(map(decimal, numbers)).encode()).hexdigest())
                out[2].append(sha256(coder.decode(numbers).decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(frugal(run), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
