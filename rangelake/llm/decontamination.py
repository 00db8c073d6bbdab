"""Benchmark decontamination: every passage of the corpus queries a BM25 index of the test items.

The index is small (the items are sharded by INDEX_CHARS, and each shard is broadcast in turn), so documents are never
shuffled. Term and length statistics are those of all items, however many shards there are, and so is the passage: a
document is cut into passages of twice the longest item's words, half overlapping, so any item's copy lies whole in one. A passage's distinct words are the query; impacts are divided by the item's score against itself, so a
score is the share of the item that the passage accounts for, and all items of THRESHOLD and above are retrieved.

Retrieval is block-max WAND. Its first test, whether the terms' greatest impacts can reach the threshold at all (for the
whole index, then for blocks of items), is made for all passages of a batch at once; the few that pass walk the postings
with pivots and block maxima. A retrieved item is a leak if the shares of the n-grams of its question and of its answer
that stand in the document both reach OVERLAP. The answer is what follows the last question mark, else the last
sentence, else the last quarter. Of an item of fewer than LEAST words, the whole must stand there as one phrase.

Defined cases: null and empty texts have no passage. Items without a word, and null ones, can't be found; an empty
benchmark finds nothing. An item without item_id is reported with a null item_id. Repeated rows are judged one by one,
repeated items are reported each. Words are runs of letters, digits and underscores in lower case; of scripts that are
written without spaces, each letter is a word. Other columns are ignored, and carried along by ``clean_documents``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangelake.llm.shared import steps

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, LEAST = 0.6, 0.6, 5
#: Characters of items in an index: what is broadcast at once.
INDEX_CHARS = 16 << 20
#: Characters of a text that are worked on at once; longer texts overlap by a passage.
CHUNK = 1 << 20
#: Scripts that are written without spaces: Thai, Lao, Burmese, Khmer, kana and Chinese characters.
_UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[^\W{_UNSPACED}]+|(?=\w)[{_UNSPACED}]")
_INSIDE = re.compile(rf"[^\W{_UNSPACED}]")
_SPACED_WORD, _ANY_UNSPACED = re.compile(r"\w+"), re.compile(f"[{_UNSPACED}]")


def words_of(text: str) -> list[str]:
    text = text.lower()
    try:  # most texts have no letter that needs the dearer pattern, and most of those none beyond Latin-1
        text.encode("latin-1")
    except UnicodeEncodeError:
        if _ANY_UNSPACED.search(text):
            return _WORD.findall(text)
    return _SPACED_WORD.findall(text)


def split_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer."""
    for mark in (r"\?(?=[^?]*\w)", r"[.!\n](?=[^.!\n]*\w[^.!\n]*[.!\n]*\s*$)"):
        at = [m.end() for m in re.finditer(mark, text)]
        if at and words_of(text[: at[-1]]):
            return words_of(text[: at[-1]]), words_of(text[at[-1] :])
    words = words_of(text)
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def grams(words: list[str], n: int) -> set[tuple[str, ...]]:
    return set(zip(*(words[i:] for i in range(n)), strict=False)) if len(words) >= n else set()


class Statistics:
    """Of items: how many there are, their words, those of the longest, and in how many of them each term stands."""

    def __init__(self) -> None:
        self.items, self.words, self.longest, self.found_in = 0, 0, 0, Counter()

    def add(self, words: list[str]) -> None:
        if words:
            self.items += 1
            self.words += len(words)
            self.longest = max(self.longest, len(words))
            self.found_in.update(dict.fromkeys(words, 1))


class Index:
    """Postings with block maxima; items are numbered 0 to len(ids) - 1. Without ``statistics``, those of ``items`` count."""

    def __init__(self, items: list[tuple[int | None, str]], statistics: Statistics | None = None) -> None:
        kept = [(i, t, words_of(t)) for i, t in items]
        kept = [x for x in kept if x[2]]
        self.ids = [i for i, _, _ in kept]
        self.parts = [split_answer(t) for _, t, _ in kept]
        if statistics is None:
            statistics = Statistics()
            for _, _, w in kept:
                statistics.add(w)
        self.longest = statistics.longest if kept else 0
        average = statistics.words / max(statistics.items, 1)
        counts = [Counter(w) for _, _, w in kept]
        self.terms = {t: k for k, t in enumerate(dict.fromkeys(t for c in counts for t in c))}
        idf = {t: math.log(1 + (statistics.items - statistics.found_in[t] + 0.5) / (statistics.found_in[t] + 0.5)) for t in self.terms}
        self.postings: list[list[int]] = [[] for _ in self.terms]
        self.impacts: list[list[float]] = [[] for _ in self.terms]
        self.block = max(8, -(-len(kept) // 64))
        self.block_max = np.zeros((len(self.terms), max(1, -(-len(kept) // self.block))), dtype=np.float32)
        for k, (c, (_, _, w)) in enumerate(zip(counts, kept, strict=True)):
            raw = {t: idf[t] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(w) / average)) for t, n in c.items()}
            whole = sum(raw.values())
            for t, x in raw.items():
                term = self.terms[t]
                self.postings[term].append(k)
                self.impacts[term].append(x / whole)
                self.block_max[term, k // self.block] = max(self.block_max[term, k // self.block], x / whole * (1 + 1e-6))
        self.greatest = self.block_max.max(axis=1) if len(self.terms) else np.zeros(0, np.float32)

    def retrieve(self, terms: list[int], threshold: float, blocks: list[int] | None = None) -> list[tuple[int, float]]:
        """Block-max WAND: all items whose score reaches the threshold; ``blocks`` are those that can hold one, if known.

        Inside a block the pivot is where the block's maxima of the terms, in the order of their next items, first add up
        to the threshold: no item before it can.
        """
        terms = np.asarray(terms)
        out = []
        for block in range(self.block_max.shape[1]) if blocks is None else blocks:
            most = self.block_max[terms, block].tolist()
            if sum(most) < threshold:
                continue
            end, live = (block + 1) * self.block, []
            for t, m in zip(terms.tolist(), most, strict=True):
                if m > 0:
                    postings = self.postings[t]
                    at = bisect_left(postings, block * self.block)
                    live.append((postings[at], at, t, m))  # a maximum above 0 says that there is one
            while live:
                live.sort()
                bound, pivot = 0.0, -1
                for item, _, _, m in live:
                    bound += m
                    if bound >= threshold:
                        pivot = item
                        break
                if pivot < 0:
                    break
                settled = live[0][0] == pivot
                if settled:
                    score = sum(self.impacts[t][at] for item, at, t, _ in live if item == pivot)
                    if score >= threshold:
                        out.append((pivot, score))
                moved = []
                for entry in live:
                    item, at, t, m = entry
                    if item < pivot or (settled and item == pivot):
                        postings = self.postings[t]
                        at = bisect_left(postings, pivot + settled, at)
                        if at < len(postings) and postings[at] < end:
                            moved.append((postings[at], at, t, m))
                    else:
                        moved.append(entry)
                live = moved
        return out


def overlaps(item: tuple[list[str], list[str]], words: list[str]) -> tuple[float, float]:
    """Shares of the question's and of the answer's n-grams (of up to five words) among those of ``words``; of a short
    item, whether it stands there whole."""
    whole = [*item[0], *item[1]]
    if len(whole) < LEAST:
        there = float(tuple(whole) in grams(words, len(whole)))
        return there, there
    shares = []
    for part in item:
        n = min(5, len(part))
        own = grams(part, n) if n else set()
        shares.append(len(own & grams(words, n)) / len(own) if own else 1.0)
    return shares[0], shares[1]


def _chunks(text: str, words: int) -> Iterator[list[str]]:
    """Words of a text in pieces, each of which begins with the last ``words`` of the one before."""
    if len(text) <= CHUNK:
        yield words_of(text)
        return
    at, tail = 0, []
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and _INSIDE.match(text[end]):  # not inside a word
            end += 1
        piece = tail + words_of(text[at:end])
        yield piece
        at, tail = end, piece[-words:]


def leaks(texts: list[str | None], index: Index, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[dict[int, tuple[float, float, float]]]:
    """Of each text: item number -> (score, question overlap, answer overlap)."""
    out: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
    half = index.longest
    if not half:
        return out
    pieces = [(k, words) for k, t in enumerate(texts) if t for words in _chunks(t, 2 * half) if words]
    lookup = index.terms.get
    passages, terms, owner, begin, base = [], [], [], [], 0
    for k, (_, words) in enumerate(pieces):
        ids = np.array([lookup(w, -1) for w in words], dtype=np.int64)
        place = np.flatnonzero(ids >= 0)
        count = max(1, -(-len(words) // half) - 1)
        for shift in (0, 1):  # a word lies in two passages
            p = place // half - shift
            ok = (p >= 0) & (p < count)
            passages.append(p[ok] + base)
            terms.append(ids[place[ok]])
        owner += [k] * count
        begin += [half * i for i in range(count)]
        base += count
    if not base:
        return out
    keys = np.unique(np.concatenate(passages) * len(index.terms) + np.concatenate(terms))
    passage, term = np.divmod(keys, len(index.terms))
    bound = np.bincount(passage, weights=index.greatest[term], minlength=base)
    open_ = (bound >= threshold)[passage]
    passage, term = passage[open_], term[open_]
    if not len(passage):
        return out
    first = np.flatnonzero(np.append(True, np.diff(passage) != 0))
    ends = np.append(first[1:], len(passage))
    for lo in range(0, len(first), 4096):  # block bounds of some passages at a time
        a, z = first[lo], ends[min(lo + 4096, len(first)) - 1]
        blocks = np.add.reduceat(index.block_max[term[a:z]], first[lo : lo + 4096] - a, axis=0)
        for j in np.flatnonzero((blocks >= threshold).any(axis=1)) + lo:
            p = int(passage[first[j]])
            text, words = pieces[owner[p]]
            for item, score in index.retrieve(term[first[j] : ends[j]], threshold, np.flatnonzero(blocks[j - lo] >= threshold).tolist()):
                if item in out[text] and out[text][item][0] >= score:
                    continue
                q, a_ = overlaps(index.parts[item], words[begin[p] : begin[p] + 2 * half])
                if q >= overlap and a_ >= overlap:
                    out[text][item] = (score, q, a_)
    return out


def shards(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of the items, each of INDEX_CHARS at most in expectation; no item is left out."""
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // INDEX_CHARS))

    def shard(k: int) -> list[tuple[int | None, str]]:
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect() if n > 1 else items.collect()
        return sorted(((r["item_id"], r["text"]) for r in own), key=lambda x: (x[0] is None, x[0] or 0, x[1]))

    statistics = None
    if n > 1:
        statistics = Statistics()
        for k in range(n):
            for _, text in shard(k):
                statistics.add(words_of(text))
    for k in range(n):
        yield Index(shard(k), statistics)


def _report(batches: Iterator[pa.RecordBatch], index: Index, threshold: float, overlap: float) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        rows = [(d, index.ids[i], *x) for d, found in zip(batch.column("doc_id").to_pylist(), leaks(batch.column("text").to_pylist(), index, threshold, overlap), strict=True) for i, x in sorted(found.items())]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """One row per document and item that it leaks: doc_id, item_id, score, question_overlap, answer_overlap."""
    found: DataFrame | None = None
    for index in shards(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        own = docs.select("doc_id", "text").mapInArrow(lambda b, shared=shared: _report(b, shared.value, threshold, overlap), "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")
        found = own if found is None else found.unionByName(own)
    return found


def clean_documents(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """``docs`` without the rows that leak an item."""

    def keep(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = leaks(batch.column("text").to_pylist(), shared.value, threshold, overlap)
            yield batch.filter(pa.array([not x for x in found], pa.bool_()))

    for index in shards(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = docs.mapInArrow(lambda b, shared=shared: keep(b, shared), docs.schema)
    return docs
