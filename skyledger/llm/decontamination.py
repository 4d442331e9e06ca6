"""Test items in training texts, by a BM25 index of the items and block-max WAND.

Items are cut to parts of at most PART words and indexed by term; the weight of a term in a part
is its BM25 weight by the sum over the part, so a passage that holds a whole part scores 1. Every
passage of a text, WINDOW words with half of it shared with the next, is a query: any run of a
part's length lies in one. All parts that reach LEAST are retrieved. Passages for which not even
the blocks' maxima add up to LEAST are left out for a batch of texts at once; the rest go through
block-max WAND. What is retrieved is verified on the text around the passage: runs of GRAM words
of the first half of the item (the question) and of the second (the answer) must be there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.shared import for_python, id_and_text, ids_of, with_row_keys
from skyledger.llm.words import IS_MARK, batches, encoded, shingle_hashes, word_hashes

PART = 32
WINDOW = 64
STEP = WINDOW // 2
LEAST = 0.6

# For sums in single precision, and passages whose bounds are added at once.
MARGIN = 1e-4
AT_ONCE = 4096

# Okapi constants.
K1, B = 1.2, 0.75

# Parts in a block of a posting list, parts of an index, and indexes sent to the tasks at once.
BLOCK = 4
INDEX_PARTS = 1024
INDEXES = 16

GRAM = 3
HALF_SHARE = 0.5
WHOLE_SHARE = 0.6

FOUND = "doc_id long, item_id long, bm25 double, question_share double, answer_share double, first_word long"


@dataclass(frozen=True)
class Item:
    item_id: int
    grams: tuple[np.ndarray, np.ndarray]
    words: int


@dataclass(frozen=True)
class Index:
    """Postings of one group of parts, sorted by term and then by part."""

    terms: np.ndarray
    first: np.ndarray
    parts: np.ndarray
    weights: np.ndarray
    block_best: np.ndarray
    item_of: np.ndarray
    items: list[Item]


def _grams(words: np.ndarray) -> np.ndarray:
    return np.unique(shingle_hashes(words, GRAM))


def build_indexes(rows: list[tuple[int, str | None]]) -> list[Index]:
    """Indexes of INDEX_PARTS parts each; an item without words is in none."""
    words, upto = word_hashes(encoded([t for _, t in rows]), IS_MARK)
    items, parts, begin = [], [], 0
    for (item_id, _), end in zip(rows, upto.tolist(), strict=True):
        own, begin = words[begin:end], end
        if not len(own):
            continue
        half = max(1, len(own) // 2) if len(own) > 1 else 1
        items.append(Item(item_id, (_grams(own[:half]), _grams(own[half:])), len(own)))
        count = -(-len(own) // PART)
        parts += [(len(items) - 1, p) for p in np.array_split(own, count)]
    return [_index(parts[k : k + INDEX_PARTS], items) for k in range(0, len(parts), INDEX_PARTS)]


def _index(parts: list[tuple[int, np.ndarray]], items: list[Item]) -> Index:
    term = np.concatenate([np.unique(p) for _, p in parts])
    counts = np.concatenate([np.unique(p, return_counts=True)[1] for _, p in parts])
    part = np.repeat(np.arange(len(parts)), [len(np.unique(p)) for _, p in parts])
    lengths = np.array([len(p) for _, p in parts])
    terms, code = np.unique(term, return_inverse=True)
    holding = np.bincount(code)
    rarity = np.log(1 + (len(parts) - holding + 0.5) / (holding + 0.5))
    share = counts * (K1 + 1) / (counts + K1 * (1 - B + B * lengths[part] / lengths.mean()))
    weight = rarity[code] * share
    weight /= np.bincount(part, weight)[part]
    order = np.lexsort((part, code))
    best = np.zeros((len(terms), -(-len(parts) // BLOCK)), dtype=np.float32)
    np.maximum.at(best, (code, part // BLOCK), weight.astype(np.float32))
    first = np.concatenate([[0], np.cumsum(holding)])
    return Index(terms, first, part[order], weight[order], best, np.array([i for i, _ in parts]), items)


def block_max_wand(index: Index, terms: np.ndarray, least: float) -> list[tuple[int, float]]:
    """(part, score) of all parts that score at least ``least`` for a query of distinct term numbers."""
    lists = [[int(index.first[t]), int(index.first[t + 1]), t, float(index.block_best[t].max())] for t in terms.tolist()]
    found = []
    while True:
        lists = [x for x in lists if x[0] < x[1]]
        lists.sort(key=lambda x: index.parts[x[0]])
        # The pivot: the first part that the maxima of the lists up to it allow to reach the bound.
        total, pivot = 0.0, -1
        for k, x in enumerate(lists):
            total += x[3]
            if total >= least:
                pivot = k
                break
        if pivot < 0:
            return found
        part = int(index.parts[lists[pivot][0]])
        while pivot + 1 < len(lists) and index.parts[lists[pivot + 1][0]] == part:
            pivot += 1
        block = part // BLOCK
        if sum(float(index.block_best[x[2], block]) for x in lists[: pivot + 1]) < least:
            # No part of this block up to the next list's part can reach it.
            target = (block + 1) * BLOCK
            if pivot + 1 < len(lists):
                target = min(target, int(index.parts[lists[pivot + 1][0]]))
            target = max(target, part + 1)
            for x in lists[: pivot + 1]:
                x[0] += int(np.searchsorted(index.parts[x[0] : x[1]], target))
        elif index.parts[lists[0][0]] == part:
            score = sum(float(index.weights[x[0]]) for x in lists[: pivot + 1])
            if score >= least:
                found.append((part, score))
            for x in lists[: pivot + 1]:
                x[0] += 1
        else:
            for x in lists[:pivot]:
                x[0] += int(np.searchsorted(index.parts[x[0] : x[1]], part))


def _candidates(index: Index, words: np.ndarray, upto: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text, first word, distinct term numbers) of the passages that the maxima let through."""
    at = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[at] == words)
    if not len(known):
        return
    begins = np.concatenate([[0], upto[:-1]])
    steps = -(-(upto - begins) // STEP)
    first_step = np.cumsum(steps) - steps
    text = np.searchsorted(upto, known, "right")
    step = first_step[text] + (known - begins[text]) // STEP
    # A word counts for the passage that starts at its step and for the one a step before.
    earlier = step > first_step[text]
    passage = np.concatenate([step, step[earlier] - 1])
    pairs = np.unique(passage * len(index.terms) + np.concatenate([at[known], at[known[earlier]]]))
    owner, term = pairs // len(index.terms), pairs % len(index.terms)
    # What every term can give at most is a cheaper bound, and most passages end here.
    edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    sizes = np.diff(np.concatenate([edges, [len(owner)]]))
    near = np.add.reduceat(index.block_best.max(axis=1)[term], edges) >= LEAST - MARGIN
    term, owner, sizes = term[np.repeat(near, sizes)], owner[edges][near], sizes[near]
    edges = np.cumsum(sizes) - sizes
    for first in range(0, len(owner), AT_ONCE):
        last = min(first + AT_ONCE, len(owner))
        upper = int(edges[last]) if last < len(edges) else len(term)
        sums = np.add.reduceat(index.block_best[term[edges[first] : upper]], edges[first:last] - edges[first], axis=0)
        for k in (first + np.flatnonzero(sums.max(axis=1) >= LEAST - MARGIN)).tolist():
            owner_text = int(np.searchsorted(first_step + steps, owner[k], "right"))
            start = (int(owner[k]) - int(first_step[owner_text])) * STEP
            yield owner_text, start, term[edges[k] : edges[k] + sizes[k]]


def _share(grams: np.ndarray, near: np.ndarray) -> float:
    return float(np.isin(grams, near).mean()) if len(grams) else 1.0


def find_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, bm25, question_share, answer_share, first_word`` per text and test item in it.

    ``items`` has item_id and text. A row is given for the best passage if WHOLE_SHARE of the
    item's runs of words and HALF_SHARE of those of each half are in the text around it; shares
    are of runs of GRAM words without case and punctuation. Null and empty texts and items match
    nothing; rows that share an id are texts of their own, and so are items.

    The items are read to the driver, whose indexes go to the tasks in groups of
    INDEXES * INDEX_PARTS parts; with more items, the texts are read once for each group.
    """
    spark = docs.sparkSession
    rows = items.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL AND item_id IS NOT NULL")
    indexes = build_indexes(sorted((r["item_id"], r["text"]) for r in rows.distinct().toLocalIterator()))
    texts = for_python(id_and_text(docs))
    results = [texts.mapInPandas(lambda frames: iter(()), FOUND)] if not indexes else []
    for k in range(0, len(indexes), INDEXES):
        group = spark.sparkContext.broadcast(indexes[k : k + INDEXES])

        def search(frames: Iterator[pd.DataFrame], group=group) -> Iterator[pd.DataFrame]:
            for frame in frames:
                ids, coded = ids_of(frame), encoded(frame["text"])
                found = []
                for first, last in batches(coded):
                    words, upto = word_hashes(coded[first:last], IS_MARK)
                    best: dict[tuple[int, int], tuple] = {}
                    for index in group.value:
                        for text, start, terms in _candidates(index, words, upto):
                            for part, score in block_max_wand(index, terms, LEAST):
                                verified = _verify(index, part, words, upto, text, start)
                                key = (text, int(index.item_of[part]))
                                if verified and (key not in best or (score, *verified) > best[key][:3]):
                                    best[key] = (score, *verified, start)
                    found += [(ids.iloc[first + text], group.value[0].items[i].item_id, *b) for (text, i), b in best.items()]
                out = pd.DataFrame(found, columns=[c.split()[0] for c in FOUND.split(", ")])
                yield out.astype({"doc_id": "Int64"})

        results.append(texts.mapInPandas(search, FOUND))
    out = results[0]
    for more in results[1:]:
        out = out.union(more)
    return out


def _verify(index: Index, part: int, words: np.ndarray, upto: np.ndarray, text: int, start: int) -> tuple[float, float] | None:
    """Shares of the halves of a part's item in the text around a passage, if they are enough."""
    item = index.items[int(index.item_of[part])]
    begin = int(upto[text - 1]) if text else 0
    here = begin + start
    near = words[max(begin, here - item.words) : min(int(upto[text]), here + WINDOW + item.words)]
    runs = _grams(near) if len(near) >= GRAM else near
    shares = []
    for half in item.grams:
        # A half shorter than a run is looked up as a run of its own length.
        shares.append(_share(half, runs) if item.words // 2 >= GRAM else 1.0)
    if item.words // 2 < GRAM:
        whole = float(np.isin(np.concatenate(item.grams), _short_runs(near, item)).mean())
        shares = [whole, whole]
    sizes = [len(g) for g in item.grams]
    whole = (shares[0] * sizes[0] + shares[1] * sizes[1]) / max(1, sum(sizes))
    return (shares[0], shares[1]) if min(shares) >= HALF_SHARE and whole >= WHOLE_SHARE else None


def _short_runs(near: np.ndarray, item: Item) -> np.ndarray:
    """Runs of the lengths that the halves of a very short item have."""
    half = max(1, item.words // 2)
    return np.concatenate([shingle_hashes(near, half), shingle_hashes(near, max(1, item.words - half))])


def without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in whose own text no test item is found; all columns stay.

    Rows without id are searched as well, and of rows that share an id each is judged by itself.
    """
    keyed = with_row_keys(docs, "__key")
    bad = find_items(keyed.select(F.col("__key").alias("doc_id"), "text"), items)
    return keyed.join(bad.select(F.col("doc_id").alias("__key")).distinct(), "__key", "left_anti").select(*[keyed[f"`{c}`"] for c in docs.columns])
