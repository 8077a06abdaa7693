"""Language-model scoring with a hashed maximum-entropy model.

Words are symbols: the ``EXACT`` most frequent ones stand for themselves, all others
share ``MEMBERS`` hashed symbols.  Symbols form ``CLASSES`` classes by frequency, and

    P(word | history) = P(class | history) P(symbol | class, history) P(word | symbol).

The first two are softmaxes over sums of weights of hashed features of the
history: the last word, the word before it (a skip feature), and both together.
The third is the smoothed share of the word among the training tokens of its symbol,
``(c + 0.5) / (N_s + 0.5 (V_s + 1))``, which keeps room for an unseen word.
The biases start at the symbols' frequencies, so training starts at the unigram model.

Training: in each round every partition takes its share of the training documents through
AdaGrad steps from the common weights and sends, for each feature, its change and how often it saw the
feature; the next weights are the changes averaged by those counts.  Each training
document is in exactly one round, so all tokens are learned from once.

What the two softmaxes learn is of fixed size: words beyond the ``EXACT`` first take n-gram and skip evidence as one of
``MEMBERS`` hashed symbols only, inside which their own counts decide.  The counts grow with the corpus; the weights don't,
and they depend a little on how the training documents lie in partitions, as each takes its own steps.

Counts of all words are exact.  Words among the ``EXACT`` and the next most frequent,
``HEAD`` in all at most, are looked up in the tasks; the rest are joined with the counts
in a shuffle.  Words are known by a 64-bit hash, taken once for each distinct word of a piece of some MB of text.

Scale: the tasks hold ``HEAD`` counts and the weights (about 6 MB), both of fixed size.
What grows (counts, rare words) is only shuffled.  Changes are summed by
(slice of the weights, lane) and then by slice, so no task takes all partitions' messages.

Defined cases: null text is empty and has the end token only; with no training
tokens the base is log10(0.5 / 0.5) a token; repeated rows count and score
each for itself; words of equal count are ranked by their hash; very long texts are read whole; empty input gives no rows; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firn.llm.common import fold, stored

CLASSES, MEMBERS = 64, 32
SYMBOLS = CLASSES * MEMBERS
EXACT = SYMBOLS - MEMBERS
HEAD = 1 << 16
PAIRS = 1 << 12
CLASS_ROWS = 1 + 2 * SYMBOLS + PAIRS  # bias, last word, word before, both
MEMBER_LAST, MEMBER_SKIP = 1 << 14, 1 << 13
MEMBER_ROWS = CLASSES + MEMBER_LAST + MEMBER_SKIP  # a bias a class, then hashed (feature, class)
BLOCK = 1024  # tokens of a softmax at once
STEP = 8192  # tokens of a training step
SLICES = 16
END = b"\n"  # no word has white space


class _WordHashes(dict):
    """Hashes of single words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _hashes_of(words: pa.Array) -> np.ndarray:
    words = words.cast(pa.binary()).to_numpy(zero_copy_only=False)
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words with that of ``END`` last, each token's place among them, and each text's number of tokens."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    coded = lists.flatten().dictionary_encode()
    places = coded.indices.to_numpy()
    words = lists.value_lengths().to_numpy()
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()  # what stands before or behind white space at an edge
    if empty >= 0:
        text = np.repeat(np.arange(len(words)), words)[places == empty]
        words = words - np.bincount(text, minlength=len(words))
        places = places[places != empty]
    lengths = words.astype(np.int64) + 1
    is_word = np.ones(lengths.sum(), bool)
    is_word[lengths.cumsum() - 1] = False
    tokens = np.full(len(is_word), len(coded.dictionary), np.int64)
    tokens[is_word] = places
    return np.append(_hashes_of(coded.dictionary), _hashes_of(pa.array([END]))), tokens, lengths


def _pieces(batch: pa.RecordBatch, column: int, most: int = 1 << 22):
    """The batch in runs of rows, cut where its texts pass a multiple of ``most`` bytes."""
    if not batch.num_rows:
        return
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff((sizes.cumsum() - sizes) // most)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        yield batch.slice(a, b - a)


def _count_tokens(batches, most: int = 4_000_000):
    held, n = [], 0

    def out():
        words, back = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        times = np.zeros(len(words), np.int64)
        np.add.at(times, back, np.concatenate([t for _, t in held]))
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(times)], names=["word", "times"])
    for batch in batches:
        for piece in _pieces(batch, 0):
            hashes, tokens, _ = split_words(piece.column(0))
            times = np.bincount(tokens, minlength=len(hashes))
            held.append((hashes[times > 0], times[times > 0]))
            n += len(tokens)
            if n >= most:
                yield out()
                held, n = [], 0
    if held:
        yield out()


class Vocabulary:
    """Counts of the head words, their symbols, and what each symbol holds in all."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, tokens: np.ndarray, types: np.ndarray):
        """``words`` by falling count; ``tokens`` and ``types`` per symbol."""
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        rank = np.empty(len(words), np.int64)
        rank[:] = np.arange(len(words))[order]
        self.symbols = np.where(rank < EXACT, rank, hashed_symbol(self.words))
        self.tokens, self.types = tokens, types
        # a word's code is its place here, or behind them its hashed symbol
        self.symbol_of = np.concatenate((self.symbols, EXACT + np.arange(MEMBERS)))
        self.count_of = np.concatenate((self.counts, np.full(MEMBERS, -1, np.int64)))

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return hashes % MEMBERS
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, len(self.words) + hashes % MEMBERS)

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol of each word, and its count, -1 outside the head."""
        codes = self.codes(hashes)
        return self.symbol_of[codes], self.count_of[codes]


def hashed_symbol(words: np.ndarray) -> np.ndarray:
    return EXACT + (words % MEMBERS)


def first_weights(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All zero but the biases, which give each symbol its frequency."""
    share = (tokens + 0.5).reshape(CLASSES, MEMBERS)
    of_class, of_member = np.zeros((CLASS_ROWS, CLASSES), np.float32), np.zeros((MEMBER_ROWS, MEMBERS), np.float32)
    of_class[0] = np.log(share.sum(axis=1) / share.sum())
    of_member[:CLASSES] = np.log(share / share.sum(axis=1, keepdims=True))
    return of_class, of_member


def class_features(last: np.ndarray, skip: np.ndarray) -> tuple:
    """Rows of the class weights; the bias is row 0, a slice for all tokens alike."""
    both = (last * 40503 + skip * 30011) % PAIRS
    return slice(0, 1), 1 + last, 1 + SYMBOLS + skip, 1 + 2 * SYMBOLS + both


def member_features(last: np.ndarray, skip: np.ndarray, of: np.ndarray) -> tuple:
    return (of, CLASSES + (last * 31337 + of * 7919) % MEMBER_LAST,
            CLASSES + MEMBER_LAST + (skip * 28657 + of * 6007) % MEMBER_SKIP)


def _exponentials(weights: np.ndarray, features: tuple, rows: slice) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of the summed weights of these tokens' features, less each token's maximum; and the maxima."""
    z = weights.take(features[-1][rows], axis=0)
    for f in features[:-1]:
        z += weights[f] if isinstance(f, slice) else weights.take(f[rows], axis=0)
    top = z.max(axis=1, keepdims=True)
    z -= top
    return np.exp(z, out=z), top


def _blocks(n: int):
    return (slice(a, a + BLOCK) for a in range(0, n, BLOCK))


def _softmax(weights: np.ndarray, features: tuple) -> np.ndarray:
    out = np.empty((len(features[-1]), weights.shape[1]), weights.dtype)
    for rows in _blocks(len(out)):
        z, _ = _exponentials(weights, features, rows)
        np.divide(z, z.sum(axis=1, keepdims=True), out=out[rows])
    return out


def _log_normalisers(weights: np.ndarray, features: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Each token's maximum and the logarithm of what its exponentials below that sum to."""
    top, total = np.empty(len(features[-1]), weights.dtype), np.empty(len(features[-1]), weights.dtype)
    for rows in _blocks(len(top)):
        z, most = _exponentials(weights, features, rows)
        top[rows], total[rows] = most[:, 0], np.log(z.sum(axis=1))
    return top, total


def _sum_at(weights: np.ndarray, features: tuple, answer: np.ndarray) -> np.ndarray:
    z = weights[features[-1], answer]
    for f in features[:-1]:
        z += weights[f.start if isinstance(f, slice) else f, answer]
    return z


def _history(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Last symbol and the one before, inside each document; an end stands before a document's first word."""
    end = symbols[lengths.cumsum() - 1] if len(lengths) else symbols[:0]
    starts = np.concatenate(([0], lengths.cumsum()[:-1]))
    last = np.concatenate((symbols[:1], symbols[:-1]))
    last[starts] = end
    skip = np.concatenate((last[:1], last[:-1]))
    skip[starts] = end
    return last, skip


def _distinct(in_order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate(([True], in_order[1:] != in_order[:-1]))
    return in_order[first], first.cumsum() - 1


def log_probs(symbols, last, skip, of_class, of_member) -> np.ndarray:
    """log10 P(symbol | history).  Each distinct history sums its classes once, each (history, class) its members."""
    if not len(symbols):
        return np.empty(0)
    seen, back = np.unique((last * SYMBOLS + skip) * SYMBOLS + symbols, return_inverse=True)
    group, group_of = _distinct(seen // MEMBERS)
    history, history_of = _distinct(group // CLASSES)
    last, skip = history // SYMBOLS, history % SYMBOLS
    top, total = _log_normalisers(of_class, class_features(last, skip))
    c, last, skip = group % CLASSES, last[history_of], skip[history_of]
    log_class = _sum_at(of_class, class_features(last, skip), c) - top[history_of] - total[history_of]
    top, total = _log_normalisers(of_member, member_features(last, skip, c))
    features = member_features(last[group_of], skip[group_of], c[group_of])
    log_member = _sum_at(of_member, features, seen % MEMBERS) - top[group_of] - total[group_of]
    return (log_class[group_of] + log_member).astype(float)[back] / math.log(10)


def _sums_by(rows: np.ndarray, order: np.ndarray, at: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Sums of the rows in ``order``, from each place of ``at`` on for ``times`` rows.  Most features of a step are seen
    once or twice: these are taken as they are, as each sum of ``reduceat`` costs more than a few additions."""
    out = rows.take(order[at], axis=0)
    two = np.flatnonzero(times == 2)
    out[two] += rows.take(order[at[two] + 1], axis=0)
    three = np.flatnonzero(times == 3)
    out[three] += rows.take(order[at[three] + 1], axis=0) + rows.take(order[at[three] + 2], axis=0)
    more = times > 3
    if more.any():
        # two floats as one complex number: additions are the same, and fewer
        pairs = rows.take(order[np.repeat(more, times)], axis=0).view(np.complex64)
        starts = times[more].cumsum() - times[more]
        out[more] = np.add.reduceat(pairs, starts, axis=0).view(np.float32)
    return out


class Trainer:
    """AdaGrad over mini-batches from given weights, with one step size for each
    feature; remembers how often each feature was seen."""

    def __init__(self, of_class, of_member, rate: float):
        self.weights = (of_class.copy(), of_member.copy())
        self.squares = tuple(np.full(len(w), 1e-2, np.float32) for w in self.weights)
        self.seen = tuple(np.zeros(len(w), np.int64) for w in self.weights)
        self.rate = rate

    def _step(self, k: int, features: tuple, answer: np.ndarray) -> None:
        w = self.weights[k]
        error = _softmax(w, features)
        error[np.arange(len(answer)), answer] -= 1
        for f in features:
            if isinstance(f, slice):
                rows, gradient, times = f, error.sum(axis=0, keepdims=True), len(answer)
            else:
                order = f.astype(np.uint16).argsort(kind="stable")  # sorted by digits
                f = f[order]
                at = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1])))
                rows, times = f[at], np.diff(at, append=len(f))
                gradient = _sums_by(error, order, at, times)
            self.squares[k][rows] += np.einsum("ij,ij->i", gradient, gradient)
            gradient *= (self.rate / np.sqrt(self.squares[k][rows]))[:, None]
            w[rows] -= gradient
            self.seen[k][rows] += times

    def learn(self, symbols, last, skip) -> None:
        for a in range(0, len(symbols), STEP):
            b = slice(a, a + STEP)
            c = symbols[b] // MEMBERS
            self._step(0, class_features(last[b], skip[b]), c)
            self._step(1, member_features(last[b], skip[b], c), symbols[b] % MEMBERS)


def _slices(n: int):
    edges = np.linspace(0, n, SLICES // 2 + 1).astype(int)
    return list(zip(edges[:-1], edges[1:]))


_MESSAGE = "part int, slice int, lane int, seen binary, change binary"


def _whole_documents(batches, vocabulary: Vocabulary, least: int):
    """Codes and lengths of whole documents in turn, closed as soon as they have ``least`` tokens."""
    held, n = [], 0
    for batch in batches:
        for piece in _pieces(batch, 0):
            hashes, tokens, lengths = split_words(piece.column(0))
            codes, ends, a, start = vocabulary.codes(hashes)[tokens], lengths.cumsum(), 0, 0
            while (b := int(np.searchsorted(ends, start + least - n)) + 1) <= len(ends):
                held.append((codes[start:ends[b - 1]], lengths[a:b]))
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, n, a, start = [], 0, b, ends[b - 1]
            held.append((codes[start:], lengths[a:]))
            n += len(codes) - start
    if n:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _train(vocabulary: Vocabulary, of_class, of_member, rate: float, lanes: int):
    def run(batches):
        trainer, any_text = Trainer(of_class, of_member, rate), False
        for codes, lengths in _whole_documents(batches, vocabulary, 32 * STEP):
            any_text, symbols = True, vocabulary.symbol_of[codes]
            trainer.learn(symbols, *_history(symbols, lengths))
        if any_text:
            lane = TaskContext.get().partitionId() % lanes
            for k, start in enumerate((of_class, of_member)):
                for s, (a, b) in enumerate(_slices(len(start))):
                    change = (trainer.weights[k][a:b] - start[a:b]) * trainer.seen[k][a:b, None]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([s], pa.int32()), pa.array([lane], pa.int32()),
                         pa.array([trainer.seen[k][a:b].tobytes()], pa.binary()),
                         pa.array([change.astype(np.float32).tobytes()], pa.binary())],
                        names=["part", "slice", "lane", "seen", "change"])
    return run


def _sum_messages(messages: pd.DataFrame) -> pd.DataFrame:
    first = messages.iloc[0]
    seen = sum(np.frombuffer(x, np.int64) for x in messages["seen"])
    change = sum(np.frombuffer(x, np.float32) for x in messages["change"])
    return pd.DataFrame({"part": [first["part"]], "slice": [first["slice"]], "lane": [0], "seen": [seen.tobytes()],
                         "change": [change.astype(np.float32).tobytes()]})


def train(texts: DataFrame, vocabulary: Vocabulary, rounds: int = 2, rate: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Weights after ``rounds`` rounds over disjoint shares of ``texts`` (column text)."""
    weights = first_weights(vocabulary.tokens)
    lanes = max(1, math.isqrt(texts.rdd.getNumPartitions()))
    for r in range(rounds):
        share = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == r)
        sums = (share.mapInArrow(_train(vocabulary, *weights, rate, lanes), _MESSAGE)
                .groupBy("part", "slice", "lane").applyInPandas(_sum_messages, _MESSAGE)
                .groupBy("part", "slice").applyInPandas(_sum_messages, _MESSAGE))
        weights = tuple(w.copy() for w in weights)
        for m in sums.collect():  # one row a slice, of fixed size
            w = weights[m["part"]]
            a, b = _slices(len(w))[m["slice"]]
            seen = np.frombuffer(m["seen"], np.int64)[:, None]
            w[a:b] += np.frombuffer(m["change"], np.float32).reshape(b - a, -1) / np.maximum(seen, 1)
    return weights


_SCORED = ("row long, doc_id {}, held_out boolean, n_tokens long, n_known long, log_counts double, model double, "
           "rare array<long>")


def _score(vocabulary: Vocabulary, of_class, of_member):
    per_symbol = np.log10(vocabulary.tokens + 0.5 * (vocabulary.types + 1))

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        first_rare = len(vocabulary.words)
        for batch in batches:
            for part in _pieces(batch, 2):
                hashes, tokens, lengths = split_words(part.column(2))
                code = vocabulary.codes(hashes)[tokens]
                symbols, counts, head = vocabulary.symbol_of[code], vocabulary.count_of[code], code < first_rare
                model = log_probs(symbols, *_history(symbols, lengths), of_class, of_member) - per_symbol[symbols]
                starts = np.concatenate(([0], lengths.cumsum()[:-1]))
                logs = np.where(head, np.log10(np.maximum(counts, 0) + 0.5), 0.0)
                known = np.add.reduceat(head.astype(np.int64), starts)
                rare = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], (lengths - known).cumsum())), pa.int32()),
                                                pa.array(hashes[tokens[~head]]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + np.arange(len(lengths)), pa.int64()), part.column(0), part.column(1),
                    pa.array(lengths, pa.int64()), pa.array(known, pa.int64()),
                    pa.array(np.add.reduceat(logs, starts)), pa.array(np.add.reduceat(model, starts)), rare],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_known", "log_counts", "model", "rare"])
                row += len(lengths)
    return run


def head_words(counts: DataFrame, most: int = HEAD) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` words that occur most often (all, if there are fewer), by falling count and then by hash, and their
    counts.  Counts fall into steps of a sixteenth of a power of two; whole steps are fetched as they are, and of the step that
    would be too many the first words in order, so what reaches the driver is ``most`` words at most."""
    step = F.floor(F.log2("times") * 16).cast("int")
    sizes = sorted(((r["step"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, n = None, 0
    for at, size in sizes:
        if n + size > most:
            break
        least, n = at, n + size
    words = counts.select("word", "times")
    parts = [] if least is None else [words.where(step >= least).toPandas()]
    cut = [at for at, _ in sizes if least is None or at < least][:1]
    if cut and n < most:
        parts.append(words.where(step == cut[0]).orderBy(F.desc("times"), "word").limit(most - n).toPandas())
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    top = pd.concat(parts).sort_values(["times", "word"], ascending=[False, True])
    return top["word"].to_numpy(np.int64), top["times"].to_numpy(np.int64)


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 1


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2,
                    rate: float = 0.5) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row per
    document; learned from the documents that are not held out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = rows.where("not held_out").select("text")
    counts = stored(texts.mapInArrow(_count_tokens, "word long, times long").groupBy("word")
                    .agg(F.sum("times").alias("times")), "lm-counts")
    words, times = head_words(counts)
    symbol = F.pmod("word", F.lit(MEMBERS))
    # the rest of the words by hashed symbol; the exact ones taken out again
    tail = counts.groupBy(symbol.alias("s")).agg(F.sum("times").alias("tokens"), F.count("*").alias("types")).collect()
    tokens, types = np.zeros(SYMBOLS, np.int64), np.zeros(SYMBOLS, np.int64)
    for r in tail:
        tokens[EXACT + r["s"]], types[EXACT + r["s"]] = r["tokens"], r["types"]
    np.subtract.at(tokens, hashed_symbol(words[:EXACT]), times[:EXACT])
    np.subtract.at(types, hashed_symbol(words[:EXACT]), 1)
    n_exact = len(words[:EXACT])
    tokens[:n_exact], types[:n_exact] = times[:EXACT], 1
    n_tokens, n_types = int(tokens.sum()), int(types.sum())
    vocabulary = Vocabulary(words, times, tokens, types)
    weights = train(texts, vocabulary, rounds, rate)

    scored = stored(rows.mapInArrow(_score(vocabulary, *weights), _SCORED.format(rows.schema["doc_id"].dataType.simpleString())),
                    "lm-scored")
    rare = (scored.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("n"))
            .join(counts, "word", "left").groupBy("row")
            .agg(F.sum(F.when(F.col("times") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
                 F.sum(F.col("n") * F.log10(F.coalesce("times", F.lit(0)) + 0.5)).alias("rare_logs")))
    logs = F.col("log_counts") + F.coalesce("rare_logs", F.lit(0.0))
    return (scored.drop("rare").join(rare, "row", "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
                    F.lit(n_tokens).cast("long").alias("train_tokens"),
                    (logs - F.col("n_tokens") * F.lit(math.log10(n_tokens + 0.5 * (n_types + 1)))).alias("base_score"),
                    (logs + F.col("model")).alias("score")))
