"""LM scoring: a causal self-attention model over subword ids, beside a base of smoothed word counts.

Tokens of the base are words (ASCII letters in lower case, cut at white space) and one end a text. They are counted over
all training documents. Of the counts, the at most HEAD most frequent words are broadcast and scored where texts are
read, as is the end; the rest, none of which is hot, is joined by word.

The model reads the subword ids of the same words, which are encoded once and kept in a table. Each id that a training
document has is a slot of its own, the most frequent ones first; one slot is for the ids that none has, one for the end.
The ids' counts are mixed in with a share of SHARE, so no token has probability 0.

The network starts from a fit on a bounded sample, SAMPLE training documents of at most LONGEST ids, by one task. It is
then trained by one pass over every token of all training documents, long ones too: in each of ROUNDS rounds all tasks go
on from the same parameters, each over its own part of a share of the documents, and their parameters are averaged,
weighted by tokens. So steps grow with the input. Each token of the pass moves the two levels of the softmax; of every
DEEP steps one moves all parameters. Windows overlap by half; each token is scored once.

Defined cases: null and empty texts have the end token alone. A null doc_id counts as the empty text in the fold and
stays null. Repeated rows count and are scored each. An empty table gives an empty result; with no training rows all
counts are 0 and the model stays as it was drawn. Of a word without a space over PIECE characters, pieces of that length
are encoded each by itself. Other columns are ignored.
"""

from __future__ import annotations

import base64
import pickle
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangelake.llm.attention import Adam, Model
from rangelake.llm.shared import STEP_BYTES, cut, in_fold, keep_freed, shared_folder, steps

VOCABULARY = "byte_bpe_50k.tiktoken"
FOLDS, HELD_OUT = 10, 0
HEAD, SAMPLE, LONGEST, STEPS, SHARE = 200_000, 1500, 8_000, 400, 0.05
#: Rates of the fit on the sample and of the first round; rounds of the pass over all training documents, and tasks that add up parameters.
FIRST_RATE, RATE, ROUNDS, ADDING = 8e-3, 4e-3, 4, 8
#: Words that a counting task holds before it passes them on; ids that a training task holds at once; characters of a word's piece.
HELD, IDS, PIECE = 400_000, 1 << 19, 400
END, OTHER = 0, 1
ENCODED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, rare array<struct<word: binary, tf: bigint>>, ids binary"


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of texts one behind the other as places in the array of distinct words, and how many each text has.

    Arrow's ASCII functions lower A to Z alone, and cut at space and tab to carriage return alone, as asked for.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    flat, each = lists.flatten(), np.asarray(pc.list_value_length(lists), dtype=np.int64)
    there = pc.not_equal(flat, "")  # white space at an end leaves an empty piece
    words = flat.filter(there).dictionary_encode()
    text = np.repeat(np.arange(len(each)), each)[np.asarray(there)]
    return np.asarray(words.indices, dtype=np.int64), np.bincount(text, minlength=len(each)), words.dictionary


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, in training documents, in all documents); the end is the empty word."""
    keep_freed()
    held: list[pa.Table] = []
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        total = pa.concat_tables(held).group_by("word").aggregate([("n", "sum"), ("n_all", "sum")])
        yield from total.select(["word", "n_sum", "n_all_sum"]).rename_columns(["word", "n", "n_all"]).to_batches()

    for batch in steps(batches, most=4 * STEP_BYTES):
        place, lengths, words = split(batch.column("text"))
        train = ~np.asarray(batch.column("held_out"), dtype=bool)
        n_all = np.append(np.bincount(place, minlength=len(words)), len(lengths))
        n = np.append(np.bincount(place[np.repeat(train, lengths)], minlength=len(words)), train.sum())
        names = pa.concat_arrays([words, pa.array([""], words.type)]).cast(pa.binary())
        held.append(pa.table([names, pa.array(n, pa.int64()), pa.array(n_all, pa.int64())], ["word", "n", "n_all"]))
        size += len(names)
        if size > HELD:
            yield from out()
            held, size = [], 0
    if held:
        yield from out()


class Subwords:
    """Ids of words by a file of ranks (base64 of a token's bytes, and its id, a line)."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.size = max(ranks.values()) + 1
        if self.size > 1 << 16:
            raise ValueError(f"{path} has ids above 65535, which the table of ids can't hold")
        self.leads = np.zeros(self.size, dtype=bool)  # tokens that begin with the space in front of a word
        self.leads[[n for token, n in ranks.items() if token.startswith(b" ")]] = True
        self.coder = tiktoken.Encoding("subwords", pat_str=rf" ?[^ ]{{1,{PIECE}}}", mergeable_ranks=ranks, special_tokens={})

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, each behind a space, one behind the other; and where each word's begin."""
        line = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py()
        ids = self.coder.encode_to_numpy(f" {line}") if len(words) else np.zeros(0, np.uint32)
        return ids.astype("<u2"), np.flatnonzero(self.leads[ids])


@cache
def subwords(name: str) -> Subwords:
    """A path, or a name in the public_tokenizers package. One for each process."""
    if "/" not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Subwords(name)


def ids_of_texts(place: np.ndarray, lengths: np.ndarray, words: pa.Array, vocabulary: str, base: Base | None = None, at: np.ndarray | None = None) -> list[bytes]:
    """Ids of each text, little-endian unsigned 16-bit integers. ``at``: where the words stand in the base's head, or -1."""
    if base is None or base.ids is None:
        ids, begin = subwords(vocabulary).of(words)
        n = np.diff(np.append(begin, len(ids)))
    else:  # the head's ids first, then those of the other words
        new = np.flatnonzero(at < 0)
        own, begins = subwords(vocabulary).of(words.take(pa.array(new)))
        ids = np.concatenate([base.ids, own])
        begin, n = base.begin.take(at, mode="clip"), np.diff(base.begin).take(at, mode="clip") if len(base.words) else np.zeros(len(at), np.int64)
        begin[new], n[new] = len(base.ids) + begins, np.diff(np.append(begins, len(own)))
    begin, n = begin.astype(np.int32), n.astype(np.int32)
    of_word = n.take(place)
    until = np.cumsum(of_word)
    start = np.repeat((begin.take(place) - (until - of_word)).astype(np.int32), of_word)
    start += np.arange(len(start), dtype=np.int32)
    flat = ids.take(start).tobytes()
    ends = (2 * np.append(0, until)[np.cumsum(lengths)]).tolist()
    return [flat[a:z] for a, z in zip([0, *ends], ends, strict=False)]


class Base:
    """What the base needs where texts are read: the head's words, and sums; bounded by HEAD."""

    def __init__(self, head: dict[bytes, int], n: int, distinct: int, ends: int) -> None:
        self.n, self.distinct, self.ends = n, distinct, ends
        self.words = pa.array(list(head), pa.binary())
        counts = np.array([*head.values(), 0])  # the last: of words that aren't in the head
        self.scores, self.known = np.append(self.of(counts[:-1]), 0.0), counts > 0

        self.ids: np.ndarray | None = None

    def encode(self, vocabulary: str) -> None:
        """Gives the head's words their ids, which tasks then need not find for each batch anew."""
        there = pc.not_equal(self.words, b"")  # not the end
        flat, begin = subwords(vocabulary).of(self.words.filter(there).cast(pa.string()))
        n = np.zeros(len(self.words) + 1, dtype=np.int64)
        n[1:][np.asarray(there, dtype=bool)] = np.diff(np.append(begin, len(flat)))
        self.ids, self.begin = flat, np.cumsum(n)

    def of(self, c: int | np.ndarray) -> float | np.ndarray:
        return np.log10((c + 0.1) / (self.n + 0.1 * (self.distinct + 1)))


def _encode(batches: Iterator[pa.RecordBatch], base: Base, vocabulary: str) -> Iterator[pa.RecordBatch]:
    """Of each text: what the head's words make of its base score, its other words, and its ids."""
    keep_freed()
    end_score, end_known = base.of(base.ends), base.ends > 0
    for batch in steps(batches):
        place, lengths, words = split(batch.column("text"))
        names = words.cast(pa.binary())
        of_words = np.asarray(pc.index_in(names, value_set=base.words).fill_null(-1))
        at = of_words[place]
        text = np.repeat(np.arange(len(lengths)), lengths)
        sums = np.bincount(text, weights=base.scores.take(at, mode="wrap"), minlength=len(lengths)) + end_score
        knowns = np.bincount(text[base.known.take(at, mode="wrap")], minlength=len(lengths)) + int(end_known)
        own = np.flatnonzero(at < 0)
        pairs, tf = np.unique(text[own] * max(1, len(words)) + place[own], return_counts=True)
        of, word = np.divmod(pairs, max(1, len(words)))
        items = pa.StructArray.from_arrays([names.take(pa.array(word)), pa.array(tf, pa.int64())], ["word", "tf"])
        rares = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(lengths) + 1)), pa.int32()), items)
        ids = ids_of_texts(place, lengths, words, vocabulary, base, of_words)
        columns = [batch.column("row"), batch.column("doc_id"), batch.column("held_out"), pa.array(lengths + 1, pa.int64()), pa.array(knowns, pa.int64()), pa.array(sums, pa.float64()), rares, pa.array(ids, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "rare", "ids"])


def _id_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, dtype=np.int64)
    for batch in batches:
        total += np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<u2"), minlength=1 << 16)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["id", "n"])


class Scorer:
    """What is broadcast: slots of ids, their prior, and the network; bounded by the vocabulary."""

    def __init__(self, counts: dict[int, int], ends: int, vocabulary: str) -> None:
        size = subwords(vocabulary).size
        n = np.zeros(size)
        n[list(counts)] = list(counts.values())
        top = np.argsort(-n, kind="stable")
        top = top[n[top] > 0]
        self.model = Model(len(top) + 2)
        self.slot = np.full(size, OTHER, dtype=np.int32)
        self.slot[top] = np.arange(2, len(top) + 2)
        self.other = -float(np.log(max(1, size - len(top))))  # of an id in slot OTHER
        prior = np.concatenate([[float(ends)], [0.0], n[top]]) + 0.5
        self.prior = prior / prior.sum()

    def slots(self, ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Slots of texts one behind the other, and their lengths; ends included."""
        lengths = np.array([len(i) // 2 for i in ids], dtype=np.int64)
        y = self.slot.take(np.frombuffer(b"".join(ids), "<u2"))
        return np.insert(y, np.cumsum(lengths), END), lengths + 1

    def score(self, ids: list[bytes]) -> np.ndarray:
        """log10 probability of each text."""
        y, lengths = self.slots(ids)
        each = np.log((1 - SHARE) * np.exp(self.model.score(y, lengths), dtype=np.float64) + SHARE * self.prior.take(y))
        each[y == OTHER] += self.other
        return np.add.reduceat(each, np.cumsum(lengths) - lengths) / np.log(10)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Slices of batches that have about IDS ids, or one longer text."""
    keep_freed()
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in steps(batches, "ids", 2 * IDS):
        own = pc.sum(pc.binary_length(batch.column("ids"))).as_py() or 0
        if held and size + own > 2 * IDS:
            yield held
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        yield held


def _fitted(spark: SparkSession, scorer: Scorer, texts: list[bytes], steps_: int) -> dict[str, np.ndarray]:
    """The parameters fitted on the sample. A task fits them, where numpy has one thread, which suits small matrices best."""
    shared = spark.sparkContext.broadcast((scorer, texts))

    def fit(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, given = shared.value
        own.model.fit(*own.slots(given), Adam(own.model.p), FIRST_RATE, steps=steps_)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(own.model.p)], pa.binary())], ["p"])

    return pickle.loads(spark.range(0, 1, 1, 1).mapInArrow(fit, "p binary").first()["p"])


def _fit_part(batches: Iterator[pa.RecordBatch], scorer: Scorer, rate: float) -> Iterator[pa.RecordBatch]:
    """(tokens, parameters after this task's texts); no row from a task without texts."""
    own = Model(len(scorer.prior))
    own.p = {k: w.copy() for k, w in scorer.model.p.items()}
    adam, n = Adam(own.p), 0
    for seed, held in enumerate(_held(batches)):
        y, lengths = scorer.slots([i for batch in held for i in batch.column("ids").to_pylist()])
        own.fit(y, lengths, adam, rate, seed)
        n += len(y)
    if n:
        yield _parameters(n, own.p)


def _parameters(n: int, p: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([pickle.dumps(p)], pa.binary())], ["n", "p"])


def _mean(parts: Iterator[tuple[int, bytes]]) -> tuple[int, dict[str, np.ndarray]]:
    """The tokens of all parts, and the mean of their parameters, weighted by tokens."""
    n, total = 0, {}
    for m, p in parts:
        n += m
        for k, w in pickle.loads(p).items():
            total[k] = total[k] + w.astype(np.float64) * m if k in total else w.astype(np.float64) * m
    return n, {k: (w / n).astype(np.float32) for k, w in total.items()}


def _add_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, mean = _mean((m.as_py(), p.as_py()) for batch in batches for m, p in zip(batch.column("n"), batch.column("p"), strict=True))
    if n:
        yield _parameters(n, mean)


def train(encoded: DataFrame, scorer: Scorer) -> int:
    """Trains the scorer's network by one pass over all training rows; gives the tokens, ends included."""
    seen = 0
    for k in range(ROUNDS):
        shared = encoded.sparkSession.sparkContext.broadcast(scorer)
        rate = RATE * (1 - 0.9 * k / ROUNDS)
        parts = encoded.filter(F.col("turn") == k).select("ids").mapInArrow(lambda b, shared=shared, rate=rate: _fit_part(b, shared.value, rate), "n long, p binary")
        n, mean = _mean((r["n"], r["p"]) for r in parts.repartition(ADDING).mapInArrow(_add_parts, "n long, p binary").collect())
        if n:
            scorer.model.p = mean
        seen += n
        shared.unpersist()
    return seen


def base_counts(rows: DataFrame, folder: str, head: int = HEAD) -> tuple[Base, DataFrame]:
    """The base, and the table of the words that aren't in its head (word, n)."""
    counts = rows.mapInArrow(_count, "word binary, n long, n_all long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all"))
    counts = cut(counts, "counts", folder)
    n, distinct = counts.agg(F.sum("n"), F.count(F.when(F.col("n") > 0, True))).first()
    level = F.floor(F.log2("n_all") * 8).cast("int")  # eight steps for each doubling, so few rows
    levels = sorted(((r["level"], r["count"]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)
    least, held = 1 << 30, 0
    for at, c in levels:
        if held + c > head:
            break
        least, held = at, held + c
    kept = {bytes(r["word"]): r["n"] for r in counts.filter(level >= least).collect()}
    ends = counts.filter("octet_length(word) = 0").agg(F.sum("n")).first()[0] or 0
    return Base(kept, n or 0, distinct or 0, ends), counts.filter(level < least).select("word", "n")


def learn(encoded: DataFrame, ends: int, vocabulary: str = VOCABULARY, sample: int = SAMPLE, steps_: int = STEPS) -> Scorer:
    """The scorer, from all training rows of the table of ids."""
    training = encoded.filter("turn >= 0")
    counts = training.select("ids").mapInArrow(_id_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    scorer = Scorer({r["id"]: r["n"] for r in counts.collect()}, ends, vocabulary)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    texts = training.filter((F.octet_length("ids") <= 2 * LONGEST) & (draw < min(1.0, 2 * sample / max(1, ends)))).select("ids", draw.alias("draw")).collect()
    texts = sorted({bytes(r["ids"]): r["draw"] for r in texts}.items(), key=lambda x: (x[1], x[0]))[:sample]
    if texts and steps_:
        scorer.model.p = _fitted(encoded.sparkSession, scorer, [t for t, _ in texts], steps_)
    train(encoded, scorer)
    return scorer


def _score(batches: Iterator[pa.RecordBatch], scorer: Scorer) -> Iterator[pa.RecordBatch]:
    for held in _held(batches):
        for batch in held:
            scores = scorer.score(batch.column("ids").to_pylist())
            names = [n for n in batch.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(scores, pa.float64())], [*names, "score"])


def score_documents(docs: DataFrame, vocabulary: str = VOCABULARY, head: int = HEAD, sample: int = SAMPLE, steps_: int = STEPS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    rows = docs.select("doc_id", in_fold(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "text")
    base, tail = base_counts(rows, folder, head)
    base.encode(vocabulary)
    shared = spark.sparkContext.broadcast(base)
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    turn = F.when(F.col("held_out"), -1).otherwise(F.pmod(F.xxhash64("row"), F.lit(ROUNDS))).cast("int").alias("turn")
    table = numbered.mapInArrow(lambda b: _encode(b, shared.value, vocabulary), ENCODED).select("*", turn)
    encoded = cut(table, "encoded", folder, by="turn")  # a round reads its own folder alone
    scorer = learn(encoded, base.ends, vocabulary, sample, steps_)

    shared_scorer = spark.sparkContext.broadcast(scorer)
    columns = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double"
    scored = encoded.select(*[c.split()[0] for c in columns.split(", ")], "ids").mapInArrow(lambda b: _score(b, shared_scorer.value), columns + ", score double")
    rare = encoded.select("row", F.inline("rare")).join(tail, "word", "left")
    c = F.coalesce("n", F.lit(0))
    each = F.col("tf") * F.log10((c + F.lit(0.1)) / F.lit(base.n + 0.1 * (base.distinct + 1)))
    added = rare.groupBy("row").agg(F.sum(each).alias("base_rare"), F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("known_rare"))
    both = scored.join(added, "row", "left")
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known_rare", F.lit(0))).alias("n_known"),
        F.lit(base.n).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base_rare", F.lit(0.0))).alias("base_score"),
        "score",
    )
