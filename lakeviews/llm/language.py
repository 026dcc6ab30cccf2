"""Language identification by segmentation-marginalised unigrams.

Each language has probabilities of the pieces of a fixed public vocabulary.  A
word's probability is the sum over all its segmentations into pieces (forward
algorithm); piece probabilities are estimated by expectation-maximisation with
the forward-backward algorithm on word counts.  A text's language is the one
under which its words are likeliest.

Learning uses about ``SAMPLE`` documents a language (those whose hash is below
the language's rate).  Words are ASCII-lower-case runs of letters, digits and
non-ASCII bytes, with a mark at the start; bytes are pieces too, so every word
has a segmentation.  Words of any length are scored whole: text written without
spaces is one long word, whose forward sums are scaled as they go.  Learning
leaves out words over ``LEARNT`` bytes.

Defined results: null texts and texts without a letter are ``und`` with score
0, as is everything when nothing can be learned; equal likelihoods go to the
language first by name; repeated rows are alike; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeviews.llm import bytewords as bw
from lakeviews.llm.common import hash60, held_out, save, slices, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLE = 3_000
ROUNDS = 4
LEARNT = 1_024  # bytes of the longest words that piece probabilities are estimated from
PLAIN = 48  # bytes of the longest words whose sums need no scaling
HELD = 1 << 18  # words whose scores a task remembers, unless one piece of texts has more
TOGETHER = 8 << 20  # bytes of texts whose new words are scored together
SPANS = 1 << 20  # spans of long words that are looked up at once
FLOOR = 1e-8
CHUNK = 1 << 20  # words repeat more in longer chunks
START = 32  # the byte that marks a word's start

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def pieces(model: str = MODEL) -> list[bytes]:
    """The vocabulary's pieces as bytes, the word mark as a space, all single bytes among them."""
    import sentencepiece

    v = sentencepiece.SentencePieceProcessor(model_file=model)
    plain = (v.id_to_piece(i) for i in range(v.get_piece_size()) if not (v.is_control(i) or v.is_unknown(i) or v.is_byte(i)))
    found = {p.replace("▁", " ").encode() for p in plain}
    found = {p for p in found if p.rfind(b" ") <= 0}  # words hold no space but their mark
    return sorted(found | {bytes([b]) for b in range(256)})


class Vocabulary:
    """Numbers of pieces by the hash of their bytes."""

    BITS = 21

    def __init__(self, listed: list[bytes]):
        self.size = len(listed)
        self.lengths = sorted({len(p) for p in listed})
        raw = np.frombuffer(b"".join(listed), np.uint8)
        ends = np.cumsum([len(p) for p in listed])
        h = bw.span_hash(bw.prefix_sums(raw), ends - [len(p) for p in listed], ends)
        self.keys = np.append(h, np.uint64(0))
        self.first = np.full(1 << self.BITS, self.size, np.int32)
        self.crowded: dict[int, int] = {}
        for i, slot in enumerate((h >> np.uint64(64 - self.BITS)).tolist()):
            if self.first[slot] == self.size:
                self.first[slot] = i
            else:
                self.crowded[int(h[i])] = i
        self.full = np.zeros(1 << self.BITS, bool)
        self.full[[k >> (64 - self.BITS) for k in self.crowded]] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of hashes; ``size`` where there is none."""
        slot = (h >> np.uint64(64 - self.BITS)).astype(np.int64)
        found = self.first[slot]
        found = np.where(self.keys[found] == h, found, self.size)
        for i in np.flatnonzero(self.full[slot] & (found == self.size)):
            found[i] = self.crowded.get(int(h[i]), self.size)
        return found


def marked(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end) of words, each with the start mark."""
    size = end - start + 1
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(int(at[-1]), np.uint8)
    out[at[:-1]] = START
    keep = np.ones(len(out), bool)
    keep[at[:-1]] = False
    out[keep] = raw[np.repeat(start - at[:-1] - 1, size - 1)[:] + np.flatnonzero(keep)]
    return out, at[:-1], at[1:]


def lattice(vocabulary: Vocabulary, raw: np.ndarray, start: np.ndarray, length: int):
    """Yields (from, to, piece numbers) of all spans of words that all have ``length`` bytes."""
    sums = bw.prefix_sums(raw)
    for i in range(length):
        for n in vocabulary.lengths:
            if i + n > length:
                break
            number = vocabulary.find(bw.span_hash(sums, start + i, start + i + n))
            if n == 1 or (number != vocabulary.size).any():
                yield i, i + n, number


def log_probability(vocabulary: Vocabulary, probability: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(words x languages): log of the sum over all segmentations; probability has a row of zeros at the end."""
    out = np.zeros((len(start), probability.shape[1]))
    size = end - start
    for length in np.unique(size[size <= PLAIN]):
        at = np.flatnonzero(size == length)
        alpha = np.zeros((length + 1, len(at), probability.shape[1]))
        alpha[0] = 1
        for i, j, number in lattice(vocabulary, raw, start[at], int(length)):
            alpha[j] += alpha[i] * probability[number]
        out[at] = np.log(np.maximum(alpha[length], 1e-300))
    long = np.flatnonzero(size > PLAIN)
    if len(long):
        out[long] = long_log_probability(vocabulary, probability, raw, start[long], end[long])
    return out


def long_log_probability(vocabulary: Vocabulary, probability: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The same for words of any length, byte by byte for all of them at once.

    Of the forward sums only those within the longest piece are kept, divided
    by the greatest of them, whose log is added up.
    """
    order = np.argsort(start - end, kind="stable")  # the longest first
    begin, size = start[order], (end - start)[order]
    lengths, reach = np.array(vocabulary.lengths), vocabulary.lengths[-1]
    n, langs = len(order), probability.shape[1]
    sums = bw.prefix_sums(raw)
    # back[:, k]: the sum up to k + 1 bytes before the byte that comes next
    back, scale = np.zeros((n, reach, langs)), np.zeros((n, langs))
    back[:, 0] = 1
    at, total = 0, int(size[0])
    while at < total:
        alive = int(np.searchsorted(-size, -at, "left"))
        to = min(total, at + max(1, SPANS // (alive * len(lengths))))
        # pieces that end after each byte of this stretch, by length
        stop = begin[:alive, None, None] + np.arange(at + 1, to + 1)[None, :, None]
        first = stop - lengths
        inside = (first >= begin[:alive, None, None]) & (stop <= (begin + size)[:alive, None, None])
        number = np.full(inside.shape, vocabulary.size)
        number[inside] = vocabulary.find(bw.span_hash(sums, first[inside], np.broadcast_to(stop, inside.shape)[inside]))
        for j in range(to - at):
            own = int(np.searchsorted(-size, -(at + j), "left"))  # words that have this byte
            new = (back[:own, lengths - 1] * probability[number[:own, j]]).sum(1)
            greatest = np.maximum(new, 1e-300)
            back[:own, 1:] = back[:own, :-1] / greatest[:, None]
            back[:own, 0] = new / greatest
            scale[:own] += np.log(greatest)
        at = to
    out = np.empty((n, langs))
    out[order] = scale + np.log(np.maximum(back[:, 0], 1e-300))
    return out


def expected(vocabulary: Vocabulary, probability: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Expected piece counts of words that occur n times, summed over all segmentations (forward-backward, in logs for long words)."""
    out = np.zeros(vocabulary.size + 1)
    size = end - start
    with np.errstate(divide="ignore"):
        logs = np.log(probability)
    for length in np.unique(size):
        at = np.flatnonzero(size == length)
        spans = list(lattice(vocabulary, raw, start[at], int(length)))
        back = sorted(spans, key=lambda s: -s[0])
        if length <= PLAIN:
            alpha, beta = np.zeros((2, length + 1, len(at)))
            alpha[0] = beta[length] = 1
            for i, j, number in spans:
                alpha[j] += alpha[i] * probability[number]
            for i, j, number in back:
                beta[i] += beta[j] * probability[number]
            weights = ((number, alpha[i] * probability[number] * beta[j] / np.maximum(alpha[length], 1e-300)) for i, j, number in spans)
        else:
            alpha, beta = np.full((2, length + 1, len(at)), -np.inf)
            alpha[0] = beta[length] = 0
            for i, j, number in spans:
                alpha[j] = np.logaddexp(alpha[j], alpha[i] + logs[number])
            for i, j, number in back:
                beta[i] = np.logaddexp(beta[i], beta[j] + logs[number])
            weights = ((number, np.exp(alpha[i] + logs[number] + beta[j] - alpha[length])) for i, j, number in spans)
        for number, weight in weights:
            out += np.bincount(number, n[at] * weight, vocabulary.size + 1)
    return out


def _words(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row and index of the distinct word of each word; bytes, hashes, starts and ends of the distinct words)."""
    raw = _LOWER[raw]
    w = bw.words(raw, offs, bw.PUNCTUATION)
    h, one, which = np.unique(w.hash, return_index=True, return_inverse=True)
    return w.row, which, raw, h, w.start[one], w.end[one]


def _counted(batches):
    for b in batches:
        langs = np.array(b.column("lang").to_pylist(), object)
        for lo, hi, raw, offs in bw.chunks(b.column("text"), CHUNK):
            row, which, lower, _, start, end = _words(raw, offs)
            own, start, end = marked(lower, start, end)
            part = langs[lo:hi]
            for lang in sorted(set(part)):
                n = np.bincount(which[(part == lang)[row]], minlength=len(start))
                used = np.flatnonzero((n > 0) & (end - start <= LEARNT))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array([own[start[i]:end[i]].tobytes() for i in used], pa.binary()),
                                                  pa.array(n[used], pa.int64())], ["lang", "word", "n"])


def word_counts(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, word, n) of about ``sample`` documents of each language, none held out."""
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(F.col("lang").isNotNull() & ~held_out("doc_id"))
    rates = rows.groupBy("lang").agg(F.least(F.lit(float(1 << 60)), F.lit(float(sample)) * float(1 << 60) / F.count(F.lit(1))).alias("rate"))
    known = {r["lang"]: r["rate"] for r in rates.collect()}  # a row per language
    if not known:
        return rows.sparkSession.createDataFrame([], "lang string, word binary, n long")
    rate = F.element_at(F.map_from_entries(F.array(*[F.struct(F.lit(k), F.lit(v)) for k, v in known.items()])), F.col("lang"))
    chosen = rows.filter(hash60(F.col("doc_id"), F.col("text")) < rate).select("lang", "text")
    return (chosen.mapInArrow(_counted, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))


def learn(docs: DataFrame, model: str = MODEL, sample: int = SAMPLE) -> tuple[list[str], list[bytes], np.ndarray]:
    """(languages, pieces, piece probabilities by language)."""
    spark: SparkSession = docs.sparkSession
    listed = pieces(model)
    counts = save(word_counts(docs, sample), "language-words")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    probability = np.full((len(listed) + 1, len(langs)), 1 / len(listed))
    probability[-1] = 0
    for _ in range(ROUNDS if langs else 0):
        shared = spark.sparkContext.broadcast((listed, langs, probability))

        def step(batches, shared=shared):
            own, names, now = shared.value
            vocabulary = Vocabulary(own)
            total = np.zeros((len(own) + 1, len(names)))
            for b in batches:
                tags, n = np.array(b.column("lang").to_pylist(), object), b.column("n").to_numpy()
                text = b.column("word").to_pylist()
                for k in range(len(names)):
                    mine = np.flatnonzero(tags == names[k])
                    if len(mine):
                        size = np.array([len(text[i]) for i in mine])
                        end = np.cumsum(size)
                        raw = np.frombuffer(b"".join(text[i] for i in mine), np.uint8)
                        total[:, k] += expected(vocabulary, now[:, k], raw, end - size, end, n[mine])
            at, k = np.nonzero(total[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(at, pa.int32()), pa.array(total[at, k])], ["k", "piece", "n"])

        sums = counts.mapInArrow(step, "k int, piece int, n double").groupBy("k", "piece").agg(F.sum("n").alias("n"))
        new = np.zeros((len(listed), len(langs)))
        for r in sums.collect():  # vocabulary times languages at most
            new[r["piece"], r["k"]] = round(r["n"], 6)
        new /= np.maximum(new.sum(0), 1e-9)
        probability[:-1] = (1 - FLOOR * len(listed)) * new + FLOOR
    return langs, listed, probability


class Scores:
    """Log-probabilities of words by language; those of words seen lately are remembered by their hash."""

    def __init__(self, vocabulary: Vocabulary, probability: np.ndarray, most: int = HELD):
        self.vocabulary, self.probability, self.most = vocabulary, probability, most
        self._forget()

    def _forget(self) -> None:
        self.known, self.values = np.zeros(0, np.uint64), np.zeros((0, self.probability.shape[1]))

    def _new(self, h: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, h)
        there = np.flatnonzero(at < len(self.known))
        new = np.ones(len(h), bool)
        new[there] = self.known[at[there]] != h[there]
        return np.flatnonzero(new)

    def of(self, chunks: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """Of the distinct words (bytes, hashes, starts, ends) of some chunks; words new to all are scored together."""
        if len(self.known) + sum(len(self._new(h)) for _, h, _, _ in chunks) > self.most:
            self._forget()
        hashes, parts, begin, end, size = [], [], [], [], 0
        for raw, h, start, stop in chunks:
            new = self._new(h)
            own, first, last = marked(raw, start[new], stop[new])
            hashes.append(h[new])
            parts.append(own)
            begin.append(first + size)
            end.append(last + size)
            size += len(own)
        h, one = np.unique(np.concatenate(hashes), return_index=True)
        if len(h):
            scored = log_probability(self.vocabulary, self.probability, np.concatenate(parts), np.concatenate(begin)[one], np.concatenate(end)[one])
            at = np.searchsorted(self.known, h)
            self.known, self.values = np.insert(self.known, at, h), np.insert(self.values, at, scored, 0)
        return [self.values[np.searchsorted(self.known, h)] for _, h, _, _ in chunks]


def predict(docs: DataFrame, learned: tuple[list[str], list[bytes], np.ndarray], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(learned)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("lettered"))

    def predicted(batches):
        langs, listed, probability = shared.value
        scores = Scores(Vocabulary(listed), probability)
        names = np.array([*langs, "und"], object)
        for b in (x for whole in batches for x in slices(whole, TOGETHER)):
            best, sure = np.full(b.num_rows, len(langs)), np.zeros(b.num_rows)
            chunks = []
            for lo, hi, raw, offs in bw.chunks(b.column("text"), CHUNK) if langs else ():
                chunks.append((lo, hi, *_words(raw, offs)))
            logs_of = scores.of([c[4:] for c in chunks]) if chunks else ()
            for (lo, hi, row, which, *_), logs in zip(chunks, logs_of):
                total = np.stack([np.bincount(row, logs[which, k], hi - lo) for k in range(len(langs))], 1)
                top = total.argmax(1)
                best[lo:hi] = top
                sure[lo:hi] = 1 / np.exp(np.maximum(total - total[np.arange(hi - lo), top][:, None], -700)).sum(1)
            no = ~b.column("lettered").to_numpy(zero_copy_only=False)
            best[no], sure[no] = len(langs), 0
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(names[best], pa.string()), pa.array(sure)], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(predicted, f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double")


def op4_language(spark, sf_dir: str, model: str = MODEL) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = predict(docs, learn(docs, model))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
