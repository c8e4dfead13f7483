"""BPE encoding and decoding with forced boundaries.

Bytes that never stand side by side inside a token of the vocabulary can never
be merged, so between them every encoding has a cut. A pre-token is split at
these forced cuts, each fragment is encoded on its own (and remembered, as
fragments repeat), and the ids are concatenated.

Null texts are encoded as empty texts, an empty text has no ids. Rows are
encoded one by one, so repeated rows give repeated results, and other columns
are passed on unless they bear the name of an added one, which replaces them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namelens.llm.words import BATCH_BYTES, batches, no_cycles

# How byte-level BPE splits text before the merges.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Bytes that stand for themselves in a vocabulary file; the others
# are written as the characters from 256 on, in order.
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

# Pre-tokens remembered by a Python worker; beyond, it forgets them all and starts anew.
MEMORY_PRE_TOKENS = 200_000
# Longer fragments are merged one by one with a heap.
LONG_FRAGMENT_BYTES = 64
ROWS_AT_ONCE = 20_000
NO_MERGE = np.int32(2**31 - 1)


def byte_of_character() -> dict[str, int]:
    table = {chr(b): b for b in PLAIN_BYTES}
    others = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    table.update({chr(256 + k): b for k, b in enumerate(others)})
    return table


class Vocabulary:
    """Tokens, merges and forced cuts of one tokenizer file."""

    def __init__(self, specification: str):
        spec = json.loads(specification)
        to_byte = byte_of_character()
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = {
            i: bytes(to_byte[c] for c in token)
            for token, i in model["vocab"].items()
            if token not in self.special
        }
        self.token_bytes.update({i: s.encode() for s, i in self.special.items()})
        ids = model["vocab"]
        self.single = [0] * 256
        for c, b in to_byte.items():
            self.single[b] = ids[c]
        # (left id, right id) -> (rank, merged id)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        joined = np.zeros((256, 256), dtype=bool)
        for i, token in self.token_bytes.items():
            if i not in self.special.values():
                for a, b in zip(token, token[1:]):
                    joined[a, b] = True
        self.joined = joined
        self.pre_token = regex.compile(PRE_TOKEN)
        self.special_pattern = (
            regex.compile("|".join(regex.escape(s) for s in self.special)) if self.special else None
        )
        lengths = np.zeros(max(self.token_bytes) + 1, dtype=np.int64)
        for i, token in self.token_bytes.items():
            lengths[i] = len(token)
        self.token_lengths, self.token_starts = lengths, np.cumsum(lengths) - lengths
        self.token_table = np.frombuffer(
            b"".join(self.token_bytes.get(i, b"") for i in range(len(lengths))), dtype=np.uint8
        )
        self.known: dict[str | int, tuple[int, ...]] = {}
        keys = np.array([left << 32 | right for left, right in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self.merge_keys, self.merge_ranks = keys[order], order.astype(np.int32)
        self.merged_id = np.array([m for _, m in self.merges.values()], dtype=np.int32)
        self.single_array = np.array(self.single, dtype=np.int32)

    def fragments(self, tokens: list[bytes]) -> list[list[bytes]]:
        """Split every token at the byte pairs that occur inside no vocabulary token."""
        data = b"".join(tokens)
        buffer = np.frombuffer(data, dtype=np.uint8)
        ends = np.cumsum([len(t) for t in tokens])
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[1:-1] = ~self.joined[buffer[:-1], buffer[1:]]
        cut[ends] = True
        places = np.flatnonzero(cut)
        upto = np.searchsorted(places, ends, side="right").tolist()
        places = places.tolist()
        out, start, k = [], 0, 0
        for token, last in zip(tokens, upto):
            if last == k + 1:
                out.append([token])
                start = places[k]
            else:
                own = []
                for end in places[k:last]:
                    own.append(data[start:end])
                    start = end
                out.append(own)
            k = last
        return out

    def merged(self, fragments: list[bytes]) -> list[list[int]]:
        """Ids of every fragment: the lowest-ranked merge first, leftmost among equals."""
        out: list[list[int]] = [[]] * len(fragments)
        of_length: dict[int, list[int]] = {}
        for k, fragment in enumerate(fragments):
            of_length.setdefault(len(fragment), []).append(k)
        for length, places in of_length.items():
            if length > LONG_FRAGMENT_BYTES:
                for k in places:
                    out[k] = self._merged_long([self.single[b] for b in fragments[k]])
                continue
            for at in range(0, len(places), ROWS_AT_ONCE):
                part = places[at : at + ROWS_AT_ONCE]
                data = np.frombuffer(b"".join(fragments[k] for k in part), dtype=np.uint8)
                ids, left = self._merged_rows(self.single_array[data].reshape(len(part), length))
                for k, row, n in zip(part, ids.tolist(), left.tolist()):
                    out[k] = row[:n]
        return out

    def _found(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NO_MERGE where there is none."""
        key = left.astype(np.int64) << 32 | right
        place = np.searchsorted(self.merge_keys, key)
        place[place == len(self.merge_keys)] = 0
        return np.where(self.merge_keys[place] == key, self.merge_ranks[place], NO_MERGE)

    def _merged_rows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge equally long fragments side by side, one merge per row and round."""
        rows, length = ids.shape
        left = np.full(rows, length)
        if length == 1:
            return ids, left
        ranks = self._found(ids[:, :-1], ids[:, 1:])
        result, active = ids.copy(), np.arange(rows)
        columns = np.arange(length)
        while len(active):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(at)), at]
            go = best < NO_MERGE
            if not go.all():
                ended = ~go
                result[active[ended]] = ids[ended]
                active, ids, ranks, at, best = active[go], ids[go], ranks[go], at[go], best[go]
                if not len(active):
                    break
            n, every = left[active], np.arange(len(active))
            shift = columns[None, :] + (columns[None, :] > at[:, None])
            ids = np.take_along_axis(ids, np.minimum(shift, length - 1), axis=1)
            ids[every, at] = self.merged_id[best]
            ranks = np.take_along_axis(ranks, np.minimum(shift[:, :-1], length - 2), axis=1)
            n -= 1
            left[active] = n
            # The pairs on either side of the new token; none beyond the last token.
            ends = at >= n - 1
            ranks[every, np.minimum(at, length - 2)] = np.where(
                ends, NO_MERGE, self._found(ids[every, at], ids[every, np.minimum(at + 1, length - 1)])
            )
            inner = at > 0
            ranks[every[inner], at[inner] - 1] = self._found(
                ids[every[inner], at[inner] - 1], ids[every[inner], at[inner]]
            )
            ranks[columns[None, :-1] >= (n - 1)[:, None]] = NO_MERGE
        return result, left

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list: n log n for very long fragments."""
        import heapq

        n, merges = len(ids), self.merges
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap = []

        def push(k: int) -> None:
            j = after[k]
            if j < n:
                found = merges.get((ids[k], ids[j]))
                if found is not None:
                    heap.append((found[0], k, ids[k], ids[j])) if not started else heapq.heappush(
                        heap, (found[0], k, ids[k], ids[j])
                    )

        started = False
        for k in range(n):
            push(k)
        heapq.heapify(heap)
        started = True
        while heap:
            _, k, left, right = heapq.heappop(heap)
            j = after[k]
            if not alive[k] or j >= n or ids[k] != left or ids[j] != right:
                continue
            ids[k] = merges[left, right][1]
            alive[j] = False
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
            if before[k] >= 0:
                push(before[k])
            push(k)
        return [ids[k] for k in range(n) if alive[k]]

    def _learn(self, tokens: set[str]) -> None:
        """Remember the ids of pre-tokens: their fragments encoded, then concatenated."""
        order = list(tokens)
        parts = self.fragments([token.encode() for token in order])
        distinct = list(set(chain.from_iterable(parts)))
        ids = dict(zip(distinct, map(tuple, self.merged(distinct))))
        for token, own in zip(order, parts):
            self.known[token] = ids[own[0]] if len(own) == 1 else tuple(chain.from_iterable([ids[f] for f in own]))

    def _pieces(self, text: str) -> list:
        """Pre-tokens as strings and special tokens as ids, in order."""
        if self.special_pattern is None or not any(s in text for s in self.special):
            return self.pre_token.findall(text)
        out, place = [], 0
        for m in self.special_pattern.finditer(text):
            out += self.pre_token.findall(text[place : m.start()])
            out.append(self.special[m.group()])
            place = m.end()
        return out + self.pre_token.findall(text[place:])

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of every text. Texts of a batch share the work on unknown fragments."""
        for part in batches(texts, len):
            pieces = [self._pieces(text) for text in part]
            unknown = {p for own in pieces for p in own} - self.known.keys()
            if len(self.known) + len(unknown) > MEMORY_PRE_TOKENS and self.known:
                self.known.clear()
                unknown = {p for own in pieces for p in own}
            unknown -= set(self.special.values())
            if unknown:
                self._learn(unknown)
            for i in self.special.values():
                self.known[i] = (i,)
            known = self.known
            for own in pieces:
                yield list(chain.from_iterable([known[p] for p in own]))
            if len(self.known) > MEMORY_PRE_TOKENS:
                self.known.clear()

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's begin."""
        arrays = [np.array(ids, dtype=np.int32) for ids in self.encode_all(texts)]
        offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
        return np.concatenate([*arrays, np.zeros(0, dtype=np.int32)]), offsets

    def decode_flat(self, values: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of consecutive runs of ids. Unknown ids have no bytes."""
        known = (values >= 0) & (values < len(self.token_lengths))
        values = np.where(known, values, 0)
        lengths = np.where(known, self.token_lengths[values], 0)
        ends = np.cumsum(lengths, dtype=np.int64)
        shift = np.repeat(self.token_starts[values] - (ends - lengths), lengths)
        data = self.token_table[shift + np.arange(len(shift))].tobytes()
        at = np.concatenate(([0], ends))[offsets].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]

    def decode(self, ids: list[int]) -> str:
        """Bytes of all tokens as UTF-8; broken sequences become U+FFFD."""
        return self.decode_flat(np.array(ids, dtype=np.int64), np.array([0, len(ids)]))[0]


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(specification: bytes) -> Vocabulary:
    """One vocabulary per Python worker."""
    key = hashlib.sha256(specification).hexdigest()
    if key not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[key] = Vocabulary(specification.decode())
    return _vocabularies[key]


def with_columns(schema: T.StructType, added: list[T.StructField]) -> T.StructType:
    names = {f.name.lower() for f in added}
    return T.StructType([f for f in schema.fields if f.name.lower() not in names] + added)


def read_specification(path: str) -> bytes:
    """The tokenizer file, which lies beside the driver's program."""
    with open(path, "rb") as file:
        return file.read()


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about as many bytes as are worked on at once."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(sizes):
        held = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, held + BATCH_BYTES, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _replaced(batch: pa.RecordBatch, added: dict[str, pa.Array]) -> pa.RecordBatch:
    names = {n.lower() for n in added}
    kept = [k for k, n in enumerate(batch.schema.names) if n.lower() not in names]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(k) for k in kept), *added.values()],
        names=[*(batch.schema.names[k] for k in kept), *added],
    )


def encode(
    docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Add the token ids of ``text`` as an array column.

    With ``decoded``, the ids are decoded again in the same pass into a column of
    that name. The tokenizer file is read by the driver and broadcast: its size
    is that of a vocabulary and does not grow with the data.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_specification(tokenizer))
    added = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    if decoded is not None:
        added.append(T.StructField(decoded, T.StringType()))
    schema = with_columns(docs.schema, added)
    place = [f.name for f in docs.schema.fields].index(text)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(spec.value)
        for batch in parts:
            for part in _slices(batch, place):
                with no_cycles():
                    values, offsets = vocab.encode_flat([t or "" for t in part.column(place).to_pylist()])
                found = {ids: pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))}
                if decoded is not None:
                    found[decoded] = pa.array(vocab.decode_flat(values, offsets), pa.string())
                yield _replaced(part, found)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of an array of token ids; null ids give an empty text."""
    spec = rows.sparkSession.sparkContext.broadcast(read_specification(tokenizer))
    schema = with_columns(rows.schema, [T.StructField(text, T.StringType())])
    place = [f.name for f in rows.schema.fields].index(ids)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(spec.value)
        for batch in parts:
            lists = batch.column(place)
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            yield _replaced(batch, {text: pa.array(vocab.decode_flat(values, offsets), pa.string())})

    return rows.mapInArrow(run, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and hashes of the ids and of the decoded text of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    tokenizer = default_tokenizer()
    rows = encode(docs, tokenizer, decoded="decoded")
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.transform("ids", lambda i: i.cast("string")), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
