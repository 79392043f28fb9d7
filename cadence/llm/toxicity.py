"""Toxicity with noisy-channel deobfuscation.

1. A character language model: trigram counts of all texts of the corpus (counted in the tasks, summed by
   Spark; at most 28 ** 3 rows whatever the corpus), mixed with the trigrams of the lexicon below.
2. Tokens that look disguised (digits or signs between letters, runs of a letter, letters set apart) become
   lattices: each character may stand for itself or for the letters it imitates, a run for one or two of
   its letters, separators for nothing or for a gap between words. Viterbi search finds the most probable reading,
   and every word of it counts.
3. A lexicon is learnt from labelled documents: words chosen one after another by how significantly they
   raise the toxic rate among documents that no earlier word explains (likelihood ratio, corrected for the number of words tried). Copies of one text count once.
4. A document is scored by a logistic function of its lexicon words after restoration.

Labels come from a sample of at most ``SAMPLE`` labelled rows outside the held-out fifth; the language
model, the decoding and the scores cover every row and whole texts.

Defined cases: null and empty texts get the score of a text without lexicon words; null or repeated labels
are left out or count as one; without any toxic label nothing is toxic (score 0); rows that repeat an id are
scored on their own; a null id is scored and counts as not held out; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm import words
from cadence.llm.tables import held_out, only, stage

#: Labelled rows that a model may be fitted on.
SAMPLE = 20_000
#: Chance that any word at all enters the lexicon without reason.
ALPHA = 0.05
THRESHOLD = 0.5
#: Letters that a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
#: Channel log probabilities of a separator that stands for nothing or for a gap; even odds.
NOTHING, GAP, HALF = math.log(2 / 3), math.log(1 / 3), math.log(1 / 2)
_SIGNS = "".join(re.escape(c) for c in LEET)
#: Readings of tokens up to this length are remembered.
SHORT = 80
_RUN = re.compile(r"(.)\1{3,}", re.DOTALL)
_LETTERS = re.compile(r"[^\W\d_]+")
_DISGUISED = re.compile(rf"(?<!\S)[^\w\s]*((?=[\w{_SIGNS}.*_-]*[^\W\d_])(?:[{_SIGNS}]*[^\W\d_]+[{_SIGNS}.*_-]{{1,2}}(?=[^\W\d_]|[{_SIGNS}][^\W\d_])|[{_SIGNS}]{{1,2}}(?=[^\W\d_]))[\w{_SIGNS}.*_-]*)|(?<!\w)((?:\w[ .*_-]){{2,}}\w)(?!\w)|(\w*([^\W\d_])\4\4\w*)")
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = _CLASS[65:91] = np.arange(1, 27)
_CLASS[128:] = 27


def _codes(text: str) -> list[int]:
    return [ord(c) - 96 if "a" <= c <= "z" else 27 for c in text]


def trigrams(docs: DataFrame) -> DataFrame:
    """code, n: how often each three characters (of 26 letters, any other letter, a gap) follow one another."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(28**3, np.int64)
        for batch in batches:
            data, at = words.buffers(batch["text"])
            data = data[at[0] : at[-1]] if len(at) > 1 else data[:0]
            for k in range(0, len(data), 1 << 20):
                c = _CLASS[data[max(0, k - 2) : k + (1 << 20)]]
                if len(c) > 2:
                    total += np.bincount(c[:-2] * 784 + c[1:-1] * 28 + c[2:], minlength=28**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["code", "n"])

    return docs.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


class Decoder:
    """Viterbi search over character lattices. A word is one of the lexicon or made of trigrams, with even odds."""

    def __init__(self, corpus: np.ndarray, lexicon: dict[str, float]) -> None:
        own = np.zeros(28**3)
        #: The tree of the lexicon's letters (node -> letter -> node) and the nodes where words end.
        self.tree: list[dict[str, int]] = [{}]
        self.ends: set[int] = set()
        for w in lexicon:
            c = [0, 0, *_codes(w), 0]
            for i in range(len(c) - 2):
                own[c[i] * 784 + c[i + 1] * 28 + c[i + 2]] += 1
            node = 0
            for x in w:
                if x not in self.tree[node]:
                    self.tree[node][x] = len(self.tree)
                    self.tree.append({})
                node = self.tree[node][x]
            self.ends.add(node)
        self.listed = math.log(0.5 / max(len(lexicon), 1))
        self.log = np.log(0.5 * self._given(corpus) + 0.5 * self._given(own)).reshape(28, 28, 28).tolist()
        self.known = lru_cache(100_000)(self._read)

    @staticmethod
    def _given(n: np.ndarray) -> np.ndarray:
        n = n.reshape(28, 28, 28) + 1e-3
        bi = n.sum(0, keepdims=True)
        smooth = bi / bi.sum(2, keepdims=True)
        return ((n + 2 * smooth) / (n.sum(2, keepdims=True) + 2)).ravel()

    @staticmethod
    def lattice(token: str) -> list[list[tuple[str, float]]]:
        """For each place the readings and their channel log probabilities."""
        out: list[list[tuple[str, float]]] = []
        i = 0
        while i < len(token):
            j = i
            while j < len(token) and token[j] == token[i]:
                j += 1
            c, run = token[i], j - i
            own = [(c, 0.0)] if c.isalpha() else [(x, -0.7) for x in LEET.get(c, "")]
            if not own:
                out.append([("", NOTHING), (" ", GAP)])
            elif run >= 3:
                out.append([(x, p) for x, p in own] + [(x + x, p - 1.0) for x, p in own])
            else:
                out += [own if c.isalpha() else [*own, ("", -4.0)] for _ in range(run)]
            i = j
        return out

    def _steps(self, state: tuple[int, int, int], letter: str) -> list[tuple[tuple[int, int, int], float]]:
        """The states after one more letter (or a gap) and their log probabilities.

        A state is the last two codes and the node of the tree, which is 0 in a word made of trigrams.
        """
        a, b, node = state
        if letter == " ":
            if not b:
                return [(state, 0.0)]  # a gap beside a gap
            if node:
                return [((b, 0, 0), 0.0)] if node in self.ends else []
            return [((b, 0, 0), self.log[a][b][0])]
        c = ord(letter) - 96 if "a" <= letter <= "z" else 27
        if node:
            child = self.tree[node].get(letter)
            return [((b, c, child), 0.0)] if child else []
        p = self.log[a][b][c]
        if b:
            return [((b, c, 0), p)]
        child = self.tree[0].get(letter)
        made = ((b, c, 0), p + HALF)
        return [made, ((b, c, child), self.listed)] if child else [made]

    def _read(self, token: str) -> tuple[str, ...]:
        """The words of the most probable reading; each state holds its way back."""
        best: dict[tuple[int, int, int], tuple[float, tuple | None]] = {(0, 0, 0): (0.0, None)}
        for place in self.lattice(token):
            step: dict[tuple[int, int, int], tuple[float, tuple | None]] = {}
            for state, (p, back) in best.items():
                for letters, q in place:
                    ends = [(state, p + q)]
                    for c in letters:
                        ends = [(s, r + t) for e, r in ends for s, t in self._steps(e, c)]
                    way = (back, letters) if letters else back
                    for s, r in ends:
                        if s not in step or r > step[s][0]:
                            step[s] = (r, way)
            best = step
        last = [(p + r, i, back) for i, (s, (p, back)) in enumerate(best.items()) for _, r in self._steps(s, " ")]
        back, out = max(last)[2] if last else None, []
        while back:
            back, letters = back
            out.append(letters)
        return tuple("".join(reversed(out)).split())

    def read(self, token: str) -> tuple[str, ...]:
        """The words of a token of any length; longer runs have the lattice of a run of three."""
        token = _RUN.sub(r"\1\1\1", token)
        return self.known(token) if len(token) <= SHORT else self._read(token)

    def restored(self, text: str) -> list[str]:
        """The words read from the disguised tokens of a lower-case text."""
        return [w for m in _DISGUISED.finditer(text) for w in self.read(m[0].strip())]


def found(text: str, lexicon: dict[str, float] | frozenset, decoder: Decoder | None) -> list[str]:
    """The lexicon words of a text, plain or restored."""
    text = text.lower()
    out = [w for w in _LETTERS.findall(text) if w in lexicon]
    if decoder:
        out += [w for w in decoder.restored(text) if w in lexicon]
    return out


def labelled(docs: DataFrame, labels: DataFrame, name: str, sample: int) -> DataFrame:
    """doc_id, text, label of at most about ``sample`` rows outside the held-out fifth, chosen by hash."""
    marks = only(labels, doc_id="doc_id", label=name).filter("doc_id is not null and label is not null").filter(~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.max("label").alias("label"))
    n = marks.count()
    part = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / max(n, 1)))
    return docs.join(marks.filter(part), "doc_id")


def _evidence(t: np.ndarray, n: np.ndarray, rate: float) -> np.ndarray:
    """The likelihood-ratio statistic of t toxic ones among n, where ``rate`` was to be expected."""
    return 2 * sum(k * np.log(np.maximum(k, 1) / (np.maximum(n, 1) * p)) for k, p in ((t, rate), (n - t, 1 - rate)))


def learn_lexicon(rows: DataFrame) -> tuple[dict[str, float], float, float]:
    """(word -> weight, weight of none, toxic rate) from (doc_id, text, label)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for t, y in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                out += [(w, y) for w in set(_LETTERS.findall((t or "").lower()))]
            n = Counter(out)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in n], pa.string()), pa.array([v if k[1] else 0 for k, v in n.items()], pa.int64()), pa.array(list(n.values()), pa.int64())], ["word", "toxic", "n"])

    rows = stage(rows.groupBy("text").agg(F.max("label").cast("int").alias("label"), F.min("doc_id").alias("doc_id")), "labelled")
    size = rows.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    n, toxic = size["n"], size["toxic"] or 0
    if not toxic or toxic == n:
        return {}, 0.0, toxic / n if n else 0.0
    rate = toxic / n
    by = rows.select("text", "label").mapInArrow(count, "word string, toxic long, n long").groupBy("word").agg(F.sum("toxic").alias("t"), F.sum("n").alias("n"))
    by = stage(by, "words")
    least = 2 * math.log(max(by.count(), 1) / ALPHA)
    part = lambda k, p: F.when(k > 0, k * F.log(k / (F.col("n") * p))).otherwise(0.0)
    evidence = 2 * (part(F.col("t"), rate) + part(F.col("n") - F.col("t"), 1 - rate))
    likely = by.filter(F.col("t") > F.col("n") * rate).withColumn("g", evidence).filter(F.col("g") >= least)
    candidates = sorted(r["word"] for r in likely.select("word").collect())  # words of the sample that pass the test
    place = {w: i for i, w in enumerate(candidates)}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = [np.unique(np.array([place[w] for w in _LETTERS.findall((t or "").lower()) if w in place], np.int32)).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(has, pa.binary()), batch["label"]], ["has", "label"])

    # about SAMPLE rows at most, one per set of words and label; words as their places among the candidates
    sets = rows.select("text", "label").mapInArrow(present, "has binary, label int").groupBy("has", "label").count().collect()
    size = np.array([len(r["has"]) // 4 for r in sets], np.int64)
    word, own = np.frombuffer(b"".join(r["has"] for r in sets), np.int32), np.repeat(np.arange(len(sets)), size)
    each = np.array([r["count"] for r in sets], np.int64)
    toxic = each * np.array([r["label"] for r in sets], np.int64)
    count_of = lambda at, k: np.bincount(word[at], k[own[at]], len(candidates)).astype(np.int64)
    n, t = count_of(slice(None), each), count_of(slice(None), toxic)
    by_word = np.argsort(word, kind="stable")
    first = np.searchsorted(word[by_word], np.arange(len(candidates) + 1))
    begin, left = np.append(0, np.cumsum(size)), np.ones(len(sets), bool)
    chosen: dict[str, float] = {}
    while True:
        total, bad = int(each[left].sum()), int(toxic[left].sum())
        rest = bad / total if total else 0.0
        score = np.where(t > n * rest, _evidence(t, n, rest), -1.0) if 0 < rest < 1 else np.zeros(0)
        best = len(score) - 1 - int(np.argmax(score[::-1])) if len(score) else -1  # ties go to the greater word
        if best < 0 or score[best] < least:
            return chosen, math.log((bad + 0.5) / (total - bad + 0.5)) if total else 0.0, rate
        chosen[candidates[best]] = math.log((t[best] + 0.5) / (n[best] - t[best] + 0.5))
        gone = own[by_word[first[best] : first[best + 1]]]
        gone = gone[left[gone]]
        left[gone] = False
        at = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in gone])
        n, t = n - count_of(at, each), t - count_of(at, toxic)


class Model:
    """Lexicon, decoder and the log odds of a text without lexicon words."""

    def __init__(self, docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> None:
        corpus = np.zeros(28**3)
        for r in trigrams(docs).collect():  # 28 ** 3 rows at most
            corpus[r["code"]] = r["n"]
        self.lexicon, self.none, self.rate = learn_lexicon(labelled(docs, labels, label, sample))
        self.corpus = corpus

    def score(self, words_: list[str]) -> float:
        """Log odds: the strongest word and a little for each further one, or those of a text without any."""
        if not self.lexicon:
            return 0.0
        odds = max((self.lexicon[w] for w in words_), default=self.none) + 0.25 * max(0, len(words_) - 1)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))

    def judge(self) -> Callable[[pa.Array], tuple[pa.Array, pa.Array]]:
        """A function for tasks: texts to their scores and the lexicon words found in them."""
        held: list[Decoder] = []

        def of(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
            if not held and self.lexicon:
                held.append(Decoder(self.corpus, self.lexicon))
            terms = [found(t.as_py() or "", self.lexicon, held[0]) if held else [] for t in texts]
            return pa.array([self.score(t) for t in terms], pa.float64()), pa.array([sorted(set(t)) for t in terms], pa.list_(pa.string()))

        return of


def score_toxicity(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` (id and text as doc_id and text) with score (0 to 1) and terms (the lexicon words found)."""
    own = only(docs, doc_id=id, text=text)
    judge = Model(own, labels, label, sample).judge()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, terms = judge(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], scores, terms], ["doc_id", "score", "terms"])

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(of, f"doc_id {kind}, score double, terms array<string>")


def keep_clean(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` (all their columns) that score below the threshold."""
    judge = Model(only(docs, doc_id=id, text=text), labels, label, sample).judge()
    at = docs.columns.index(text)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, _ = judge(batch.column(at))
            yield batch.filter(pc.less(scores, threshold))

    return docs.mapInArrow(of, docs.schema)
