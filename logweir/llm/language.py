"""Language-model scoring: corpus counts, a recurrent network learnt on all training texts.

1. Spark counts every token of the training texts (words, and one end a text).
2. The ``HEAD`` commonest tokens become ids of the network; all others are told apart by class
   (their ending) for the network and by their counts within the class.
3. The network learns in ``ROUNDS``; each training text belongs to one round. In a round each
   task learns on its texts from the common weights, and Spark sums the tasks' weights by
   tokens, in two steps, to the next common weights.
4. Every text is scored whole. A word's share of its tail class is (c + 1) / Z, with c its
   count and Z the class's tokens, words and 1 for any word not counted, as in the base score.

Texts are split into words twice, to count them and to write their ids and sums to a stored
table, from which the network learns and scores. Tasks hold a dictionary of the commonest words
(at most ``DICTIONARY`` of at most ``LONGEST`` bytes). Rarer and longer words of a text travel
as rows to the counts table and back as sums, so no vocabulary has to fit anywhere.

Defined results: a null text is an empty one and has only its end; a null id is not held out;
repeated rows are scored each; without training texts the network gives all classes alike and
c, N, V are 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm import recurrent
from logweir.llm.common import materialize, utf8

#: The end of a text; no word has white space.
END = b"\n"
HEAD = 2048
TAIL = 32
ENDING = 3
#: Ids as stored.
KIND = np.dtype("<i2")
DICTIONARY, LONGEST = 400_000, 64
ROUNDS = 3
RATE = 0.01
FOLDS, HELD_OUT = 7, 2
#: Bytes of text that a task counts, and that it looks up at once; groups that sum weights.
COUNTED_BYTES = 12 << 20
HELD_BYTES = 4 << 20
#: Bytes of ids that are scored at once.
HELD_IDS = 2 << 20
SUMS = 256
#: Texts of more tokens wait for others as long, so that they step together; and how many wait.
LONG, HELD_LONG = 1024, 1_500_000


@dataclass
class Words:
    """Words of some texts: distinct ones, the number of each in order, and each text's number."""

    distinct: list[bytes]
    code: np.ndarray
    text: np.ndarray
    texts: int

    @property
    def lengths(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.texts)


def words_of(bodies: pa.Array) -> Words:
    """Lower-cased words (A-Z only) between ASCII white space."""
    try:
        split = pc.ascii_split_whitespace(pc.ascii_lower(bodies.cast(pa.string())))
    except pa.ArrowInvalid:  # bytes that are not UTF-8
        split = pa.array([b.lower().split() for b in bodies.to_pylist()], pa.list_(pa.binary()))
    words = split.flatten()
    text = np.repeat(np.arange(len(bodies)), np.diff(split.offsets.to_numpy()))
    real = pc.greater(pc.binary_length(words), 0)
    if not pc.all(real).as_py():  # at the edges of a text
        text = text[real.to_numpy(zero_copy_only=False)]
        words = words.filter(real)
    coded = words.dictionary_encode()
    return Words(coded.dictionary.cast(pa.binary()).to_pylist(), coded.indices.to_numpy(), text, len(bodies))


def _parts(batches: Iterator[pa.RecordBatch], size: int, column: str = "body") -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` bytes of the column."""

    def joined() -> Iterator[pa.RecordBatch]:
        return iter(pa.Table.from_batches(held).combine_chunks().to_batches())

    held, have = [], 0
    for batch in batches:
        start = 0
        ends = np.cumsum(pc.binary_length(batch[column]).to_numpy(zero_copy_only=False).astype(np.int64))
        while start < len(batch):
            done = ends[start - 1] if start else 0
            stop = min(max(int(np.searchsorted(ends, done + size - have, side="right")), start + 1), len(batch))
            held.append(batch.slice(start, stop - start))
            have += int(ends[stop - 1] - done)
            start = stop
            if have >= size:
                yield from joined()
                held, have = [], 0
    if sum(map(len, held)):
        yield from joined()


def is_held_out(doc_id: str = "doc_id") -> Column:
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """``texts`` (body) -> word, n."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, COUNTED_BYTES):
            found = words_of(part["body"])
            times = np.bincount(found.code, minlength=len(found.distinct))
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array([END, *found.distinct], pa.binary()), "n": pa.array(np.r_[found.texts, times])}
            )

    return texts.mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """What tasks know of the words: a bounded dictionary, and totals of everything."""

    vocabulary: recurrent.Vocabulary
    words: list[bytes]  # the head first
    counts: np.ndarray  # of ``words``
    endings: dict[bytes, int]  # class of an ending
    class_sizes: np.ndarray  # Z of each tail class
    n: int
    v: int

    def __post_init__(self):
        self.slot = {w: i for i, w in enumerate(self.words)}
        head = self.vocabulary.head
        self.ids = np.array([i if i < head else self.tail_id(w) for i, w in enumerate(self.words)], dtype=np.int32)

    def __reduce__(self):
        return Lexicon, (self.vocabulary, self.words, self.counts, self.endings, self.class_sizes, self.n, self.v)

    def tail_id(self, word: bytes) -> int:
        return self.vocabulary.head + self.endings.get(word[-ENDING:], self.vocabulary.tail - 1)

    def slots(self, words: list[bytes]) -> np.ndarray:
        get = self.slot.get
        return np.array([get(w, -1) for w in words], dtype=np.int64)

    def ids_of(self, words: list[bytes], slots: np.ndarray) -> np.ndarray:
        out = self.ids[slots]
        for i in np.flatnonzero(slots < 0).tolist():
            out[i] = self.tail_id(words[i])
        return out

    def sequences(self, found: Words, ids: np.ndarray) -> list[np.ndarray]:
        """Each text's ids with the end."""
        each = np.split(ids[found.code], np.cumsum(found.lengths)[:-1])
        return [np.append(x, np.int32(0)) for x in each]


def _short(word: str = "word") -> Column:
    return F.octet_length(word) <= LONGEST


def _ending(word: str = "word") -> Column:
    size = F.octet_length(word)
    return F.substring(F.col(word), F.greatest(size - (ENDING - 1), F.lit(1)), F.lit(ENDING))


def lexicon(counts: DataFrame) -> tuple[Lexicon, int]:
    """From the stored counts; also the count from which on the dictionary has every word."""
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    sizes = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(DICTIONARY).collect()
    held, least = 0, 1
    for row in sizes:
        if held + row["words"] > DICTIONARY:
            least = row["n"] + 1
            break
        held += row["words"]
    known = counts.where((F.col("n") >= least) & _short() | (F.col("word") == F.lit(END))).toArrow()
    rows = sorted(zip(known["word"].to_pylist(), known["n"].to_pylist(), strict=True), key=lambda r: (r[0] != END, -r[1], r[0]))
    if not rows:
        rows = [(END, 0)]
    head = min(HEAD, len(rows))
    in_head = counts.sparkSession.createDataFrame([(bytes(w),) for w, _ in rows[:head]], "head_word binary")
    tail = counts.join(in_head, F.col("word") == F.col("head_word"), "left_anti")
    # Classes of the tail: its commonest endings, and one for all other endings.
    endings = tail.groupBy(_ending().alias("ending")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    common = endings.orderBy(F.desc("n"), "ending").limit(TAIL - 1).collect()
    every = endings.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v")).first()
    size = [r["n"] + r["v"] + 1.0 for r in common]
    rest = every["n"] + every["v"] - sum(r["n"] + r["v"] for r in common) + 1.0
    size += [1.0] * (TAIL - 1 - len(size)) + [rest]
    made = Lexicon(
        recurrent.Vocabulary(head, TAIL),
        [w for w, _ in rows],
        np.array([n for _, n in rows], dtype=np.int64),
        {bytes(r["ending"]): k for k, r in enumerate(common)},
        np.array(size),
        totals["n"],
        totals["v"],
    )
    return made, least


def _ids(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b.as_buffer(), KIND).astype(np.int32) for b in column]


def learn(texts: DataFrame, known: Lexicon, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Weights learnt on ``texts`` (ids, round)."""
    head, vocabulary = known.vocabulary.head, known.vocabulary
    start = np.concatenate([np.maximum(known.counts[:head], 1), known.class_sizes])
    weights = recurrent.initial(vocabulary, start)
    for turn in range(rounds):
        rate = RATE / (1 + turn)

        def learnt(batches: Iterator[pa.RecordBatch], weights=weights, rate=rate) -> Iterator[pa.RecordBatch]:
            learner = recurrent.Learner(vocabulary, weights, rate)
            for part in _parts(batches, HELD_IDS, "ids"):
                learner.take(_ids(part["ids"]))
            learner.finish()
            if learner.learnt:
                summed = (recurrent.flat(learner.weights) * np.float32(learner.learnt)).tobytes()
                yield pa.RecordBatch.from_pydict(
                    {"slot": [TaskContext.get().partitionId() % SUMS], "learnt": [learner.learnt], "summed": [summed]}
                )

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = None, 0
            for batch in batches:
                for learnt_here, summed in zip(batch["learnt"].to_pylist(), batch["summed"], strict=True):
                    part = np.frombuffer(summed.as_py(), dtype=np.float32).astype(np.float64)
                    total = part if total is None else total + part
                    count += learnt_here
            if count:
                yield pa.RecordBatch.from_pydict({"learnt": [count], "mean": [(total / count).astype(np.float32).tobytes()]})

        parts = texts.where(F.col("round") == turn).select("ids").mapInArrow(learnt, "slot long, learnt long, summed binary")
        # Each task of the second step adds up what a few of the first have learnt.
        sums = parts.repartition("slot").mapInArrow(added, "learnt long, mean binary").collect()
        if sums:
            every = sum(r["learnt"] for r in sums)
            mean = sum(np.frombuffer(r["mean"], dtype=np.float32) * (r["learnt"] / every) for r in sums)
            weights = recurrent.shaped(mean, weights)
    return weights


def coded(rows: DataFrame, shared: Broadcast) -> DataFrame:
    """Each text's ids, and what counts say of its words; rare words with their times.

    ``rows`` has row, doc_id, held_out, round and body; ``shared`` is the broadcast lexicon.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        head = own.vocabulary.head
        log_count, log_z = np.log10(own.counts + 1.0), np.log10(own.class_sizes)
        end_log, end_seen = log_count[0], int(own.counts[0] > 0)
        for part in _parts(batches, HELD_BYTES):
            found = words_of(part["body"])
            slots = own.slots(found.distinct)
            ids = own.ids_of(found.distinct, slots)
            inside = slots >= 0
            log = np.where(inside, log_count[slots], 0.0)
            # A tail word's share of its class; the rarest words' counts are added later.
            share = np.where(ids >= head, log - log_z[np.maximum(ids - head, 0)], 0.0)

            def by_text(values: np.ndarray, found: Words = found) -> np.ndarray:
                return np.bincount(found.text, values[found.code], found.texts)

            seen = by_text((inside & (own.counts[slots] > 0)).astype(float)).astype(np.int64) + end_seen
            at = np.flatnonzero(~inside[found.code])
            pairs, times = np.unique(found.text[at] * len(found.distinct) + found.code[at], return_counts=True)
            of, word = np.divmod(pairs, max(len(found.distinct), 1))
            cuts = np.searchsorted(of, np.arange(found.texts + 1)).astype(np.int32)
            rare = pa.array([found.distinct[w] for w in word.tolist()], pa.binary())
            texts = [x.astype(KIND).tobytes() for x in own.sequences(found, ids)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part[c] for c in ("row", "doc_id", "held_out", "round")),
                    pa.array(found.lengths + 1),
                    pa.array(seen),
                    pa.array(by_text(log) + end_log),
                    pa.array(by_text(share)),
                    pa.ListArray.from_arrays(pa.array(cuts), rare),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(times)),
                    pa.array(texts, pa.binary()),
                ],
                names=[c.split()[0] for c in schema],
            )

    schema = (
        "row long", "doc_id long", "held_out boolean", "round int", "n_tokens long", "seen long", "logs double",
        "share double", "words array<binary>", "times array<long>", "ids binary",
    )
    return rows.mapInArrow(made, ", ".join(schema))


def network_scores(rows: DataFrame, vocabulary: recurrent.Vocabulary, learnt: Broadcast) -> DataFrame:
    """``rows`` with the network's log10 probability of their ``ids`` as ``network`` in their place."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = learnt.value

        def scored(rows: pa.Table, texts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            score = recurrent.score(vocabulary, weights, texts) / np.log(10)
            yield from rows.append_column("network", pa.array(score)).combine_chunks().to_batches()

        waiting: list[pa.Table] = []
        long_texts: list[np.ndarray] = []
        for part in _parts(batches, HELD_IDS, "ids"):
            texts = _ids(part["ids"])
            rows = pa.Table.from_batches([part]).drop_columns("ids")
            long = np.array([len(t) > LONG for t in texts], dtype=bool)
            yield from scored(rows.filter(pa.array(~long)), [t for t in texts if len(t) <= LONG])
            waiting.append(rows.filter(pa.array(long)))
            long_texts += [t for t in texts if len(t) > LONG]
            if sum(map(len, long_texts)) > HELD_LONG:
                yield from scored(pa.concat_tables(waiting), long_texts)
                waiting, long_texts = [], []
        if long_texts:
            yield from scored(pa.concat_tables(waiting), long_texts)

    return rows.mapInArrow(made, rows.drop("ids").schema.add("network", "double"))


def scores(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        is_held_out().alias("held_out"),
        F.pmod(F.xxhash64("doc_id"), F.lit(rounds)).cast("int").alias("round"),
        utf8("text").alias("body"),
    )
    counts = materialize(word_counts(rows.where("not held_out").select("body")), "word-counts")
    known, least = lexicon(counts)
    shared = spark.sparkContext.broadcast(known)
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    local = materialize(coded(numbered.select("row", "doc_id", "held_out", "round", "body"), shared), "coded-texts")
    learnt = spark.sparkContext.broadcast(learn(local.where("not held_out").select("ids", "round"), known, rounds))
    rare = local.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
    rare = rare.select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    looked_up = rare.join(counts.where((F.col("n") < least) | ~_short()), "word", "left")
    log_n = F.log10(F.coalesce("n", F.lit(0)) + 1.0)
    sums = looked_up.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("seen_rare"),
        F.sum(F.col("times") * log_n).alias("logs_rare"),
    )
    logs_rare = F.coalesce("logs_rare", F.lit(0.0))
    whole = local.select("row", "doc_id", "held_out", "n_tokens", "seen", "logs", "share", "ids")
    scored = network_scores(whole, known.vocabulary, learnt)
    log_base = float(np.log10(known.n + known.v + 1.0))
    return scored.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("seen") + F.coalesce("seen_rare", F.lit(0))).alias("n_known"),
        F.lit(known.n).cast("long").alias("train_tokens"),
        (F.col("logs") + logs_rare - F.col("n_tokens") * F.lit(log_base)).alias("base_score"),
        (F.col("network") + F.col("share") + logs_rare).alias("score"),
    )
