"""Language ID: labels the spans of mixed-language texts.

Method. A word is a run of letters of one script (by ranges of code points). Each script narrows
the languages that a word can have to those whose training letters use it; for these, letter
n-grams with word edges give the word a log-likelihood. Viterbi over the words of a text, with a
penalty for each change of language, gives the spans. The text's language is the one with most
letters; its score is the share of letters that its spans hold, each span weighted by the
probability of its language over the span.

A text is labelled without the dynamic programme where no segment gains half the penalty in another
language: one language is then the best path.

Learning counts n-grams of labelled texts in TABLE hashed entries per language, from at most about
`per_language` texts of each language (drawn by a hash of the id), so the model's size and cost are
bounded. Nothing but text and language is learned from, and nothing but text is scored.

Edge cases: a null text, or one without a letter, is `und` with score 0; words of a script that no
language was learned with can have any language; repeated rows give repeated results; with no
labelled row every text with letters is `und`.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import tokens
from cohortloom.llm.common import batch_of, mix, text_chunks

UNKNOWN = "und"
ORDERS = (1, 2, 3, 4)
#: Entries per language of the hashed n-gram table.
TABLE = 1 << 16
#: Labelled texts that are learned from, per language.
PER_LANGUAGE = 4_000
#: Cost of a change of language, in nats of a word's mean n-gram log-likelihood.
PENALTY = 12.0
#: Bytes of text labelled at once: many texts share the steps of the dynamic programme.
CHUNK = 3 << 19
#: A language is a candidate for a script that holds at least this share of its training letters.
SCRIPT_SHARE = 0.01

# First and last code point of script blocks (Unicode); other letters form a script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "ethiopic": [(0x1200, 0x137F)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x3134F)],
}
N_SCRIPTS = len(SCRIPTS) + 1


@lru_cache(maxsize=1)
def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: number of its script (0: no letter) and its one-letter lower case."""
    n = 0x110000
    letter = np.fromiter((chr(i).isalpha() for i in range(n)), bool, n)
    script = np.where(letter, len(SCRIPTS) + 1, 0).astype(np.uint8)
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            script[a : b + 1][letter[a : b + 1]] = k
    lower = np.arange(n, dtype=np.uint32)
    for i in np.flatnonzero(letter):
        low = chr(i).lower()
        if len(low) == 1:
            lower[i] = ord(low)
    return script, lower


class LetterRuns:
    """Runs of letters of one script in some texts, and their n-grams; places are code points."""

    def __init__(self, texts: list[str | None]):
        script_of, lower = letter_tables()
        size = [len(t or "") for t in texts]
        points = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        offsets = np.concatenate(([0], np.cumsum(size)))
        script = script_of[points]
        change = np.ones(len(points) + 1, bool)
        change[1:-1] = script[1:] != script[:-1]
        change[offsets] = True
        edge = np.flatnonzero(change)
        keep = script[edge[:-1]] > 0 if len(edge) > 1 else np.zeros(0, bool)
        self.starts, self.ends = edge[:-1][keep], edge[1:][keep]
        self.script = script[self.starts] if len(points) else np.zeros(0, np.uint8)
        self.size = self.ends - self.starts
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.text_of = np.repeat(np.arange(len(texts)), self.counts)
        self.offsets = offsets
        # letters of all words with a zero before each and after the last
        self.at = np.concatenate(([0], np.cumsum(self.size + 1)))
        self.letters = np.zeros(int(self.at[-1]) + 1, np.uint64)
        place = np.arange(int(self.size.sum())) + np.repeat(self.starts - (np.cumsum(self.size) - self.size), self.size)
        self.letters[np.delete(np.arange(len(self.letters)), self.at)] = lower[points[place]]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of the gram's first sign, table entry); edges count as signs, but not inside."""
        z, m = self.letters, len(self.letters) - n + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = np.full(m, n, np.uint64)
        good = z[:m] > 0 if n == 1 else np.ones(m, bool)
        with np.errstate(over="ignore"):
            for j in range(n):
                h = h * np.uint64(0x100000001B3) + z[j : j + m]
                if 0 < j < n - 1:
                    good &= z[j : j + m] > 0
        if n == 2:
            good &= (z[:m] > 0) | (z[1 : 1 + m] > 0)
        at = np.flatnonzero(good)
        return at, (mix(h[at]) & np.uint64(TABLE - 1)).astype(np.int64)

    def word_scores(self, table: np.ndarray) -> np.ndarray:
        """Words x languages: the mean over the orders of the summed log-likelihoods."""
        out = np.zeros((len(self.starts), table.shape[1]), np.float32)
        of = np.repeat(np.arange(len(self.starts), dtype=np.int32), self.size + 1)  # word of each sign; its edge is before it
        for n in ORDERS:
            at, entry = self.grams(n)
            if not len(at):
                continue
            word = of[at]
            begin = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            out[word[begin]] += np.add.reduceat(table[entry], begin, axis=0)
        return out / len(ORDERS)


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        """counts: languages x TABLE; scripts: languages x (N_SCRIPTS + 1) letters."""
        self.languages = languages
        share = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * TABLE)
        self.table = np.ascontiguousarray(np.log(share).T.astype(np.float32))
        self.candidate = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        self.candidate[:, ~self.candidate.any(axis=0)] = True

    def scores(self, runs: LetterRuns) -> np.ndarray:
        scores = runs.word_scores(self.table)
        if not self.candidate.all():
            scores = np.where(self.candidate[:, runs.script].T, scores, scores.max(axis=1, keepdims=True) - 30)
        return scores


def best_paths(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Label of each word: the best path through each text's words, first[i] to first[i + 1]."""
    labels = np.zeros(len(scores), np.int64)
    counts = np.diff(first)
    has = np.flatnonzero(counts)
    if not len(has):
        return labels
    begin = first[:-1][has]
    total = np.add.reduceat(scores.astype(np.float64), begin, axis=0)
    top = total.argmax(axis=1)
    of = np.repeat(np.arange(len(has)), counts[has])
    labels[:] = top[of]
    # largest gain of any segment in another language
    gain = np.zeros(len(has))
    for m in range(scores.shape[1]):
        d = (scores[:, m] - scores[np.arange(len(scores)), labels]).astype(np.float64)
        run = np.cumsum(d)
        before = run - d
        lift = 1e6 * of  # keeps the running minimum inside a text
        floor = np.minimum.accumulate((before - lift))
        gain = np.maximum(gain, np.maximum.reduceat(run - (floor + lift), begin))
    odd = has[gain > penalty / 2]
    if len(odd):
        _viterbi(scores, first, odd[np.argsort(-counts[odd], kind="stable")], penalty, labels)
    return labels


def _viterbi(scores: np.ndarray, first: np.ndarray, texts: np.ndarray, penalty: float, labels: np.ndarray) -> None:
    """All texts in step, the longest first, so that those still open are a prefix."""
    size, k = first[texts + 1] - first[texts], scores.shape[1]
    begin = first[texts]
    active = np.searchsorted(-size, -np.arange(int(size[0])), side="left")  # texts with more than t words
    best = scores[begin].astype(np.float64)
    switched = np.zeros((len(scores), k), bool)
    source = np.zeros(len(scores), np.int64)
    for t in range(1, int(size[0])):
        n = active[t]
        at, own = begin[:n] + t, best[:n]
        top = own.argmax(axis=1)
        other = own.max(axis=1) - penalty
        switched[at] = own < other[:, None]
        source[at] = top
        best[:n] = np.maximum(own, other[:, None]) + scores[at]
    now = best.argmax(axis=1)
    for t in range(int(size[0]) - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        labels[at] = now[:n]
        now[:n] = np.where(switched[at, now[:n]], source[at], now[:n])


def label_texts(texts: list[str | None], model: Model, penalty: float) -> tuple[list[str], list[float], list[list[dict]]]:
    runs = LetterRuns(texts)
    n, k = len(texts), len(model.languages)
    names, values, spans = [UNKNOWN] * n, [0.0] * n, [[] for _ in range(n)]
    if not len(runs.starts) or not k:
        return names, values, spans
    scores = model.scores(runs)
    labels = best_paths(scores, runs.first, penalty)
    new = np.ones(len(labels), bool)
    new[1:] = (labels[1:] != labels[:-1]) | (runs.text_of[1:] != runs.text_of[:-1])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(labels)) - 1
    summed = np.add.reduceat(scores.astype(np.float64), begin, axis=0)
    summed -= summed.max(axis=1, keepdims=True)
    own = labels[begin]
    sure = np.exp(summed[np.arange(len(begin)), own]) / np.exp(summed).sum(axis=1)
    letters = np.add.reduceat(runs.size, begin).astype(np.float64)
    text = runs.text_of[begin]
    held, weighed = np.zeros((n, k)), np.zeros((n, k))
    np.add.at(held, (text, own), letters)
    np.add.at(weighed, (text, own), letters * sure)
    every, main = held.sum(axis=1), held.argmax(axis=1)
    for i in np.flatnonzero(every):
        names[i], values[i] = model.languages[main[i]], float(weighed[i, main[i]] / every[i])
    for i, a, b, lab in zip(text.tolist(), begin.tolist(), last.tolist(), own.tolist()):
        zero = runs.offsets[i]
        spans[i].append({"lang": model.languages[lab], "start": int(runs.starts[a] - zero), "end": int(runs.ends[b] - zero)})
    return names, values, spans


COUNTS = pa.schema([("lang", pa.string()), ("entry", pa.int32()), ("n", pa.int64())])


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of a task's texts by language; script letters stand behind the table."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in text_chunks(batch):
            langs, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            for lang in sorted(set(langs)):
                runs = LetterRuns([t for t, x in zip(texts, langs) if x == lang])
                own = counts.setdefault(lang, np.zeros(TABLE + N_SCRIPTS + 1, np.int64))
                for n in ORDERS:
                    own[:TABLE] += np.bincount(runs.grams(n)[1], minlength=TABLE)
                own[TABLE:] += np.bincount(runs.script, weights=runs.size, minlength=N_SCRIPTS + 1).astype(np.int64)
    for lang, own in counts.items():
        entry = np.flatnonzero(own)
        yield batch_of(COUNTS, lang=[lang] * len(entry), entry=entry, n=own[entry])


def fit_language_model(labelled: DataFrame, per_language: int = PER_LANGUAGE, lang_column: str = "lang", text_column: str = "text", key: Column | None = None) -> Model:
    """Model of the labelled rows. key: what the draw of texts hashes; the text itself by default."""
    rows = labelled.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"), F.xxhash64(F.col(text_column) if key is None else key).alias("draw"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((0, TABLE)), np.zeros((0, N_SCRIPTS + 1)))
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, per_language / n)).otherwise(share)
    drawn = rows.where(F.pmod("draw", F.lit(1_000_000)) < share * 1_000_000).select("lang", "text")
    summed = drawn.mapInArrow(count_batches, "lang string, entry int, n long").groupBy("lang", "entry").agg(F.sum("n").alias("n"))
    got = summed.toArrow()
    languages = sorted(sizes)
    counts = np.zeros((len(languages), TABLE + N_SCRIPTS + 1))
    number = {x: i for i, x in enumerate(languages)}
    counts[[number[x] for x in got.column("lang").to_pylist()], got.column("entry").to_numpy()] = got.column("n").to_numpy()
    return Model(languages, counts[:, :TABLE], counts[:, TABLE:])


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())]
    + [("spans", pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))]
)


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per document: its language, the score, and the spans of each language in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch, CHUNK):
                names, values, spans = label_texts(part.column(1).to_pylist(), shared.value, penalty)
                yield batch_of(RESULT, doc_id=part.column(0), lang_pred=names, score=values, spans=spans)

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(label, "doc_id long, lang_pred string, score double, spans array<struct<lang:string,start:int,end:int>>")


def keep_identified(
    docs: DataFrame, model: Model, min_score: float, penalty: float = PENALTY, text_column: str = "text", lang_column: str | None = None
) -> DataFrame:
    """The documents, with all their columns, whose language is known with at least this score; lang_column,
    a string, then holds that language. Where no language was learned none can be told apart, and every text
    with a letter stays as it is."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_column)
    to = docs.columns.index(lang_column) if lang_column else None

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.release()
        for batch in batches:
            for part in text_chunks(batch, CHUNK, text_column):
                texts = part.column(at).to_pylist()
                if shared.value.languages:
                    names, values, _ = label_texts(texts, shared.value, penalty)
                    kept = [n != UNKNOWN and v >= min_score for n, v in zip(names, values)]
                    if to is not None:
                        part = part.set_column(to, part.schema.field(to), pa.array(names, part.schema.field(to).type))
                else:
                    lettered = set(LetterRuns(texts).text_of.tolist())
                    kept = [i in lettered for i in range(len(texts))]
                yield part.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
