"""Tokens of two vocabularies aligned by the bytes they cover, with counts of linked id pairs.

Tokens of both sides that end at the same byte cut a text into groups; within a group every token
of one side is linked with every token of the other. A pair of ids counts once for each document
that holds it linked.

Two passes. The first tokenizes, writes the ids of a block of documents to a file, and hands out
the block's distinct pairs with their document counts, by shard of the first id. The pairs of a
shard are united in a tree of blocks, a minimal perfect hash gives each a slot, and the counts of
the blocks are scattered into dense vectors that are summed in a tree as well. Then each block's
pairs are looked up: slot, comparison with the key stored there, count. The second pass opens the
block's ids, aligns them again and sums what was found for its links.

All pairs of a first id are in one shard, which has at most (ids of the second vocabulary) of
them, so the highest count of an id is known there.
"""

from __future__ import annotations

import re
import uuid
from collections import deque
from collections.abc import Iterator
from functools import cache
from itertools import chain
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.blocks import (
    arrays_as_ids,
    block_name,
    blocks_of,
    buckets_for,
    each_block,
    ids_as_arrays,
    read_arrays,
    write_arrays,
)
from skyledger.llm.perfect_hash import PerfectHash
from skyledger.llm.shared import for_python, id_and_text, materialize, scratch_path, shuffle_partitions
from skyledger.llm.tokens import BYTE_LETTERS, IS_SPACE, LONGEST_KEPT, PIECES, encoder
from skyledger.llm.words import mix

SPACE = "▁"

# Blanks at which the second side's tokens do not always part.
ODD_BLANK = re.compile(r"[^\S \n]")

# The tables of pieces start anew at this many, with those of the last batches; longer ones than LONGEST_KEPT are not kept.
MOST_KEPT = 500_000
LAST_BATCHES = 4

# Pieces that are encoded as one text.
PIECES_AT_ONCE = 4000

# Bytes of text whose tokens and links a task holds at a time.
BLOCK_BYTES = 1 << 20

# Links that are spread out at a time; a group with more than MOST_OPEN is counted by distinct ids.
MOST_OPEN = 1 << 12

# Blocks whose vectors are summed in one step of the tree.
FAN_IN = 16

ASKED = "block long, shard int, size int, pairs binary"
UNITED = "shard int, part long, size int, pairs binary"
SUMMED = "shard int, part long, counts binary"
ANSWERED = "block long, shard int, size int, found binary"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def packed(*arrays: np.ndarray) -> bytes:
    return pa.compress(b"".join(np.ascontiguousarray(x).tobytes() for x in arrays), codec="zstd", asbytes=True)


def unpacked(content: bytes, size: int, *kinds: str) -> list[np.ndarray]:
    if not size:
        return [np.zeros(0, dtype=k) for k in kinds]
    total = sum(np.dtype(k).itemsize for k in kinds) * size
    raw, out, at = pa.decompress(content, decompressed_size=total, codec="zstd", asbytes=True), [], 0
    for kind in kinds:
        out.append(np.frombuffer(raw, dtype=kind, count=size, offset=at))
        at += np.dtype(kind).itemsize * size
    return out


class TokenBytes:
    """What each id of the two vocabularies stands for in a text."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        self.first = encoder(byte_level, plain=True)
        self.second = sentencepiece.SentencePieceProcessor(model_file=pieces)
        of_letter = {letter: b for b, letter in BYTE_LETTERS.items()}
        names = self.first.tokenizer.get_vocab(with_added_tokens=True)
        self.a = [b""] * (max(names.values()) + 1)
        for name, number in names.items():
            known = all(x in of_letter for x in name)
            self.a[number] = bytes(of_letter[x] for x in name) if known else name.encode()
        self.b = [self._piece(k) for k in range(self.second.vocab_size())]
        self.a_size = np.array([len(x) for x in self.a], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b], dtype=np.int64)
        self.space = self.second.piece_to_id(SPACE)
        # Whether no token of the second side reaches over the start of a run of spaces and line feeds.
        self.parted = not any(re.search(rb"[^ \n][ \n]", x) for x in self.b)
        self.of_a: dict[str, bytes] = {}
        self.of_b: dict[str, bytes | None] = {}
        self.last: deque[set[str]] = deque(maxlen=LAST_BATCHES)
        # An id and what follows it: another one of its side in the group, or the other side or the next group.
        texts = [str(k) for k in range(max(len(self.a), len(self.b)))]
        self.written = [[f"{t}{mark}" for t in texts] for mark in ",|;"]

    def _piece(self, number: int) -> bytes:
        if self.second.is_byte(number):
            return bytes([int(self.second.id_to_piece(number)[3:5], 16)])
        return self.second.id_to_piece(number).replace(SPACE, " ").encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of both sides; none where there is no text or a side's bytes are not the text's.

        Neither side has a token over the start of a run of spaces, as long as the text has no
        other blanks than space and line feed. Such texts are put together from pieces that came up
        before; the others are encoded and compared whole.
        """
        lists = [PIECES.findall(f" {t}") if t and self.parted and not ODD_BLANK.search(t) else [] for t in texts]
        if len(self.of_b) > MOST_KEPT:
            kept = set().union(*self.last)
            if len(kept) > MOST_KEPT:
                kept = set()
                self.last.clear()
            self.of_a = {p: self.of_a[p] for p in kept}
            self.of_b = {p: self.of_b[p] for p in kept}
        own = set(chain.from_iterable(lists))
        new = own.difference(self.of_b)
        self._learn(new)
        for text, pieces in zip(texts, lists, strict=True):
            found = list(map(self.of_b.__getitem__, pieces))
            if found and None not in found:
                first = b"".join(map(self.of_a.__getitem__, pieces))
                yield np.frombuffer(first, dtype="<u4"), np.frombuffer(b"".join(found), dtype="<u4")
            else:
                yield self._whole(text)
        long = {p for p in new if len(p) > LONGEST_KEPT}
        for piece in long:
            del self.of_a[piece], self.of_b[piece]
        self.last.append(own - long)

    def _learn(self, pieces: set[str]) -> None:
        """Keep the ids of new pieces; one whose tokens do not have its bytes is marked by None."""
        # Spaces at the end of a text are no piece of a longer one.
        inner = [p for p in pieces if not IS_SPACE(p[-1])]
        alone = [p for p in pieces if IS_SPACE(p[-1])]
        for first in range(0, len(inner), PIECES_AT_ONCE):
            some = inner[first : first + PIECES_AT_ONCE]
            if not self._learn_together(some):
                alone += some
        for piece in alone:
            a = np.frombuffer(self.first.encode(piece), dtype="<u4").tolist()
            # The model puts a space before what it is given. A single space it would not see at all.
            b = self.second.encode(piece[1:] if piece[0] == " " else piece)
            if piece[0] != " ":
                b = b[1:] if b and self.b[b[0]] == b" " else [0]
            elif piece == " ":
                b = [self.space]
            whole = piece.encode()
            same = b"".join(map(self.a.__getitem__, a)) == whole == b"".join(map(self.b.__getitem__, b))
            self.of_a[piece] = pack(f"<{len(a)}I", *a)
            self.of_b[piece] = pack(f"<{len(b)}I", *b) if same else None

    def _learn_together(self, pieces: list[str]) -> bool:
        """Encode pieces as one text, if both sides give it back and have tokens that end where they do."""
        # A word in front, so that the first piece is cut off as the others are.
        text = "".join(["a", *pieces])
        whole = f" {text}".encode()
        a, b = self.first.ids(f" {text}"), np.array(self.second.encode(text), dtype="<u4")
        if not b"".join(map(self.a.__getitem__, a.tolist())) == whole == b"".join(map(self.b.__getitem__, b.tolist())):
            return False
        ends = 2 + np.cumsum(np.fromiter(map(len, map(str.encode, ["", *pieces])), dtype=np.int64, count=len(pieces) + 1))
        cuts = []
        for ids, size in ((a, self.a_size), (b, self.b_size)):
            upto = np.cumsum(size[ids])
            last = np.searchsorted(upto, ends)
            if (upto[last] != ends).any():
                return False
            cuts.append((4 * (last + 1)).tolist())
        content_a, content_b = a.tobytes(), b.tobytes()
        for k, piece in enumerate(pieces):
            self.of_a[piece] = content_a[cuts[0][k] : cuts[0][k + 1]]
            self.of_b[piece] = content_b[cuts[1][k] : cuts[1][k + 1]]
        return True

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        whole = f" {text}".encode()
        first = np.frombuffer(self.first.encode(f" {text}"), dtype="<u4")
        second = self.second.encode(text)
        same = text and b"".join(map(self.a.__getitem__, first.tolist())) == whole
        if same and b"".join(map(self.b.__getitem__, second)) == whole:
            return first, np.array(second, dtype="<u4")
        return first[:0], first[:0]


@cache
def token_bytes(byte_level: str, pieces: str) -> TokenBytes:
    """The worker's tables for two files; they live as long as the worker does."""
    return TokenBytes(byte_level, pieces)


class Alignment:
    """The groups and links of a block of documents, whose ids of both sides stand one after the other."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, sizes: TokenBytes) -> None:
        self.a, self.b, self.n_a, self.n_b = a.astype(np.int64), b.astype(np.int64), n_a, n_b
        ends_a, ends_b = np.cumsum(sizes.a_size[a]), np.cumsum(sizes.b_size[b])
        # Both sides of a document have the same bytes, so its end is an end of both.
        size = int(ends_a[-1]) + 1 if len(ends_a) else 0
        both = np.zeros(size, dtype=np.int8)
        both[ends_a] = 1
        both[ends_b] += 1
        before = np.cumsum(both == 2, dtype=np.int32) - (both == 2)
        groups = int(np.count_nonzero(both == 2))
        self.group_a, self.group_b = before[ends_a].astype(np.int64), before[ends_b].astype(np.int64)
        self.in_a = np.bincount(self.group_a, minlength=groups)
        self.in_b = np.bincount(self.group_b, minlength=groups)
        self.start_a, self.start_b = np.cumsum(self.in_a) - self.in_a, np.cumsum(self.in_b) - self.in_b
        docs_of_a = np.repeat(np.arange(len(n_a)), n_a)
        self.doc = docs_of_a[self.start_a] if groups else np.zeros(0, np.int64)
        self.n_groups = np.bincount(self.doc, minlength=len(n_a))
        self.n_links = self.by_doc(self.doc, self.in_a * self.in_b)

    def by_doc(self, doc: np.ndarray, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.n_a), dtype=np.int64)
        np.add.at(total, doc, values)
        return total

    def links(self, second_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, pair (first id * second_ids + second id) and how often, in no order; a document may repeat a pair."""
        links = self.in_a * self.in_b
        usual = (links <= MOST_OPEN)[self.group_a]
        at = np.flatnonzero(usual)
        group = self.group_a[at]
        times = self.in_b[group]
        left = np.repeat(at, times)
        inside = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
        right = np.repeat(self.start_b[group], times) + inside
        docs, pairs = [np.repeat(self.doc[group], times)], [self.a[left] * second_ids + self.b[right]]
        counts = [np.ones(len(left), dtype=np.int64)]
        for g in np.flatnonzero(links > MOST_OPEN).tolist():
            a, ca = np.unique(self.a[self.start_a[g] : self.start_a[g] + self.in_a[g]], return_counts=True)
            b, cb = np.unique(self.b[self.start_b[g] : self.start_b[g] + self.in_b[g]], return_counts=True)
            pairs.append((a[:, None] * second_ids + b[None, :]).ravel())
            counts.append((ca[:, None] * cb[None, :]).ravel())
            docs.append(np.full(len(pairs[-1]), self.doc[g]))
        return np.concatenate(docs), np.concatenate(pairs), np.concatenate(counts)

    def written(self, sizes: TokenBytes) -> Iterator[str]:
        """``a1,a2|b1;a3|b2,b3`` of each document."""
        comma, bar, semicolon = sizes.written
        last_a = np.diff(self.group_a, append=-1) != 0
        last_b = np.diff(self.group_b, append=-1) != 0
        place_a = np.arange(len(self.a)) + self.start_b[self.group_a]
        place_b = np.arange(len(self.b)) + (self.start_a + self.in_a)[self.group_b]
        many = len(comma)
        code = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        code[place_a] = self.a + np.where(last_a, many, 0)
        code[place_b] = self.b + np.where(last_b, 2 * many, 0)
        texts = [*comma, *bar, *semicolon]
        first = 0
        for size in (self.n_a + self.n_b).tolist():
            yield "".join(map(texts.__getitem__, code[first : first + size].tolist()))[:-1]
            first += size


def _shard(pairs: np.ndarray, second_ids: int, bits: int) -> np.ndarray:
    """The shard of a pair: a hash of its first id."""
    return (mix((pairs // second_ids).astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _by_shard(pairs: np.ndarray, second_ids: int, bits: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of distinct pairs by shard and value, and the shards with where theirs begin and end."""
    shard = _shard(pairs, second_ids, bits)
    order = np.lexsort((pairs, shard))
    edges = np.searchsorted(shard[order], np.arange((1 << bits) + 1)).tolist()
    return order, [(k, x, y) for k, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if x < y]


def _unite(frame: pd.DataFrame) -> pd.DataFrame:
    lists = [unpacked(c, n, "<u8")[0] for c, n in zip(frame["pairs"], frame["size"], strict=True)]
    every = np.unique(np.concatenate(lists))
    row = (frame["shard"].iloc[0], frame["next"].iloc[0], len(every), packed(every))
    return pd.DataFrame([row], columns=["shard", "part", "size", "pairs"])


def _in_tree(rows: DataFrame, blocks: int, step, schema: str) -> DataFrame:
    """Rows of ``shard, part`` brought together FAN_IN parts at a time until a shard has one row."""
    parts = blocks
    while True:
        parts = max(1, -(-parts // FAN_IN))
        place = F.pmod(F.col("part"), F.lit(parts)) if parts > 1 else F.lit(0).cast("long")
        rows = rows.withColumn("next", place).groupBy("shard", "next").applyInPandas(step, schema)
        if parts == 1:
            return rows


def align_documents(docs: DataFrame, byte_level: str, pieces: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Groups and links of every document, and the counts of its links: see ALIGNED.

    The first side is space + text by a byte-level vocabulary file, the second the text by a
    sentencepiece model, which adds the space itself. Names of special tokens in texts are plain
    text. A null or empty text, and one that a side does not give back byte by byte, has no
    tokens: zeros and empty ``groups``. ``n_best`` counts the links whose pair is in as many
    documents as any pair of its first id; ``count_sum`` sums the counts over links. Rows with a
    null or repeated id are documents of their own, and each counts. An empty table has no rows.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "aligned")
    bits = buckets_for(shuffle_partitions(spark))
    def first_pass(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = token_bytes(byte_level, pieces)
        for ids, texts in blocks_of(frames, block_bytes):
            # An attempt has names of its own, so the rows that are kept and the files they name agree.
            number = uuid.uuid4().int >> 65
            both = list(sizes.encode([t.decode("utf-8", "replace") for t in texts]))
            n_a, n_b = (np.array([len(x[k]) for x in both], dtype="<i8") for k in (0, 1))
            a, b = (np.concatenate([x[k] for x in both]) for k in (0, 1))
            write_arrays(folder, block_name(number, "ids"), [*ids_as_arrays(ids), n_a, n_b, a.astype("<u4"), b.astype("<u4")])
            doc, pair, _ = Alignment(a, b, n_a, n_b, sizes).links(len(sizes.b))
            once = np.sort(pair.astype(np.uint64) * np.uint64(len(ids)) + doc.astype(np.uint64))
            once = once[np.concatenate([[True], once[1:] != once[:-1]])] if len(once) else once
            found, counts = np.unique(once // np.uint64(len(ids)), return_counts=True)
            found = found.astype(np.int64)
            order, shards = _by_shard(found, len(sizes.b), bits)
            found, counts = found[order].astype("<u8"), counts[order].astype("<u4")
            rows = [(number, k, y - x, packed(found[x:y], counts[x:y])) for k, x, y in shards] or [(number, 0, 0, packed())]
            yield pd.DataFrame(rows, columns=["block", "shard", "size", "pairs"])

    asked = materialize(for_python(id_and_text(docs)).mapInPandas(first_pass, ASKED), "pairs")
    blocks = materialize(asked.select("block").distinct(), "blocks")
    many = blocks.count()

    def keys_only(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(
            pairs=[packed(unpacked(c, n, "<u8", "<u4")[0]) for c, n in zip(frame["pairs"], frame["size"], strict=True)]
        )
        return _unite(frame)

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, size, content in zip(frame["shard"], frame["size"], frame["pairs"], strict=True):
                (found,) = unpacked(content, size, "<u8")
                table = PerfectHash.build(mix(found))
                keys = np.zeros(len(found), dtype="<u8")
                keys[table.slots(mix(found))] = found
                write_arrays(folder, f"{shard:08d}.hash", [*table.parts(), keys])
            yield frame[["shard"]]

    def opened(shard: int) -> tuple[PerfectHash, np.ndarray]:
        *parts, keys = read_arrays(folder, f"{shard:08d}.hash")
        return PerfectHash.from_parts(*parts), np.frombuffer(keys, dtype="<u8")

    def slots(table: PerfectHash, keys: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        at = table.slots(mix(pairs.astype(np.uint64)))
        if len(at) and (at.min() < 0 or (keys[at] != pairs).any()):
            raise RuntimeError("a pair has no slot of its own")
        return at

    def scatter(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        table, keys = opened(shard)
        total = np.zeros(len(keys), dtype="<i8")
        for size, content in zip(frame["size"], frame["pairs"], strict=True):
            pairs, counts = unpacked(content, size, "<u8", "<u4")
            total[slots(table, keys, pairs)] += counts
        return pd.DataFrame([(shard, frame["next"].iloc[0], packed(total))], columns=["shard", "part", "counts"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        _, keys = opened(shard)
        total = np.zeros(len(keys), dtype="<i8")
        for content in frame["counts"]:
            total += unpacked(content, len(keys), "<i8")[0]
        return pd.DataFrame([(shard, frame["next"].iloc[0], packed(total))], columns=["shard", "part", "counts"])

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        second_ids = len(token_bytes(byte_level, pieces).b)
        for frame in frames:
            for shard, content in zip(frame["shard"], frame["counts"], strict=True):
                _, keys = opened(shard)
                (counts,) = unpacked(content, len(keys), "<i8")
                _, first = np.unique(keys // np.uint64(second_ids), return_inverse=True)
                highest = np.zeros(first.max() + 1, dtype=np.int64)
                np.maximum.at(highest, first, counts)
                write_arrays(folder, f"{shard:08d}.counts", [counts, counts == highest[first]])
            yield frame[["shard"]]

    def look_up(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        table, keys = opened(shard)
        counts, best = (np.frombuffer(x, dtype=k) for x, k in zip(read_arrays(folder, f"{shard:08d}.counts"), ("<i8", "?"), strict=True))
        found = []
        for size, content in zip(frame["size"], frame["pairs"], strict=True):
            at = slots(table, keys, unpacked(content, size, "<u8", "<u4")[0])
            found.append(packed(counts[at], best[at]))
        return pd.DataFrame({"block": frame["block"], "shard": frame["shard"], "size": frame["size"], "found": found})

    def reply(frame: pd.DataFrame) -> pd.DataFrame:
        block = int(frame["block"].iloc[0])
        frame = frame.sort_values("shard")
        both = [unpacked(c, n, "<i8", "?") for c, n in zip(frame["found"], frame["size"], strict=True)]
        write_arrays(folder, block_name(block, "counts"), [np.concatenate([x[k] for x in both]) for k in (0, 1)])
        return pd.DataFrame({"block": [block]})

    def second_pass(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = token_bytes(byte_level, pieces)
        for frame in frames:
            for number in frame["block"].tolist():
                known, null, *rest = read_arrays(folder, block_name(number, "ids"))
                n_a, n_b, a, b = (np.frombuffer(x, dtype=k) for x, k in zip(rest, ("<i8", "<i8", "<u4", "<u4"), strict=True))
                counts, best = (
                    np.frombuffer(x, dtype=k) for x, k in zip(read_arrays(folder, block_name(number, "counts")), ("<i8", "?"), strict=True)
                )
                aligned = Alignment(a, b, n_a, n_b, sizes)
                doc, pair, times = aligned.links(len(sizes.b))
                found, place = np.unique(pair, return_inverse=True)
                order, _ = _by_shard(found, len(sizes.b), bits)
                at = np.empty(len(found), dtype=np.int64)
                at[order] = np.arange(len(found))
                at = at[place]
                out = pd.DataFrame(
                    {
                        "doc_id": arrays_as_ids(known, null),
                        "n_a": n_a,
                        "n_b": n_b,
                        "n_groups": aligned.n_groups,
                        "n_links": aligned.n_links,
                        "n_best": aligned.by_doc(doc, np.where(best[at], times, 0)),
                        "count_sum": aligned.by_doc(doc, counts[at] * times),
                    }
                )
                written = aligned.written(sizes)
                for first in range(0, len(out), 1000):
                    some = out.iloc[first : first + 1000]
                    yield some.assign(groups=[next(written) for _ in range(len(some))])

    parts = max(1, -(-many // FAN_IN))
    dealt = asked.filter("size > 0").withColumn("next", F.pmod(F.xxhash64("block"), F.lit(parts))).groupBy("shard", "next")
    united = _in_tree(dealt.applyInPandas(keys_only, UNITED), parts, _unite, UNITED)
    materialize(united.mapInPandas(build, "shard int"), "hashes")
    summed = _in_tree(dealt.applyInPandas(scatter, SUMMED), parts, add, SUMMED)
    materialize(summed.mapInPandas(finish, "shard int"), "sums")
    answers = dealt.applyInPandas(look_up, ANSWERED)
    without = asked.filter("size = 0").select("block", "shard", "size", F.col("pairs").alias("found"))
    replied = materialize(answers.unionByName(without).groupBy("block").applyInPandas(reply, "block long"), "replied")
    return each_block(replied).mapInPandas(second_pass, ALIGNED)
