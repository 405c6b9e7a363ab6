"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

A lexicon is learned from labelled rows: words, and beginnings of words, whose share of toxic documents
is far above the rest's.  Features are lexicon densities by tier, closeness of lexicon words to
second-person words, and rates of capitals, punctuation and obfuscation.  Boosted trees score them; an
isotonic fit on a third of the training rows, which the lexicon and the trees have not seen, turns
scores into probabilities.  Labels, language, source and ids are never inputs.

Training takes at most SAMPLE labelled ids, those with the smallest hashes (a documented bound), and of an
id's rows the one whose text has the smallest hash; every row is scored over its whole text.  Defined cases: null and empty texts have zero features and get the score
of such a row; no usable labels at all give score 0; labels that are null are skipped; an id labelled
more than once is toxic if any of its labels says so; repeated rows are scored one by one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.llm.common import cut, doc_columns, small, table

SAMPLE = 24_000
CUTOFF = 0.3
LEXICON, SUPPORT = 4000, 6
#: Second-person words of the four languages.
SECOND = "you your yours yourself u ur du dich dir dein deine deiner euch ihr tu te toi ton ta tes vous votre vos tú usted ustedes ti tuyo vosotros".split()
#: Signs and digits that stand in for letters.
LEET = str.maketrans("@431!0$57", "aaeiiosst")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
#: Letters with signs between them (a run of letters is tried from its start alone, so long runs take linear time), or single letters apart.
_SIGNED = r"(?<![^\W\d_])[^\W\d_]++[@$!*0134]++[^\W\d_]+"
_INNER, _ONLY_SIGNED = re.compile(r"(?<=[^\W\d_])[@$!*0134]++(?=[^\W\d_])"), re.compile(_SIGNED)
_MASKED = re.compile(_SIGNED + r"|(?:\b[^\W\d_][.\-*_ ]){3,}[^\W\d_]\b")
_STRETCH = re.compile(r"([^\W\d_])\1{2,}")
_CAPS = re.compile(r"\b[^\W\d_a-zß-öø-ÿ]{3,}\b")
STEMS = (4, 5, 6, 7)
FEATURES = ["log_words", "strong_rate", "strong_log", "strong_any", "mild_rate", "mild_log", "weight_sum", "weight_max", "near_second", "second_rate", "capital_rate", "shout_rate", "punct_rate", "exclaim_rate", "question_rate", "masked_rate", "masked_hits", "stretch_rate", "digit_rate"]


def terms(text: str) -> set[str]:
    """Words and marked beginnings of words, once each."""
    words = set(_WORD.findall(text.lower()))
    out = set(words)
    for n in STEMS:
        out.update(w[:n] + "-" for w in words if len(w) > n)
    return out


def learn_lexicon(counts: list[tuple[str, int, int]], toxic: int, clean: int, most: int = LEXICON) -> dict[str, float]:
    """term -> log odds against clean rows, for terms beyond chance (z of 6 for the difference in shares)."""
    got = []
    for term, t, n in counts:
        c = n - t
        p, q, m = t / toxic, c / clean, n / (toxic + clean)
        z = (p - q) / math.sqrt(max(m * (1 - m) * (1 / toxic + 1 / clean), 1e-12))
        w = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        if t >= SUPPORT and z >= 6 and w >= 0.7:
            got.append((-z, term, w))
    return {term: w for _, term, w in sorted(got)[:most]}


def masked_words(text: str, words: list[str]) -> list[str]:
    """All of _MASKED in a text; the costly forms only run where their parts are there (four single letters; a sign between letters)."""
    if sum(len(w) == 1 for w in words) >= 4:
        return _MASKED.findall(text)
    return _ONLY_SIGNED.findall(text) if _INNER.search(text) else []


def stretches(text: str) -> int:
    """Letters that stand three times or more in a row; texts without three equal characters in a row have none."""
    u = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
    same = (u[:-2] == u[1:-1]) & (u[1:-1] == u[2:])
    letter = (((u[:-2] | 0x20) - 97).astype(np.uint16) < 26) | (u[:-2] >= 0x80)
    if not (same & letter).any() and not ((u >= 0xD800) & (u < 0xE000)).any():  # characters of two units go the long way
        return 0
    return sum(1 for _ in _STRETCH.finditer(text))


class Featurizer:
    STRONG = 2.5

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon, self.memo = lexicon, {}

    def weight(self, word: str) -> float:
        got = self.lexicon.get(word, 0.0)
        for n in STEMS:
            if len(word) > n:
                got = max(got, self.lexicon.get(word[:n] + "-", 0.0))
        if not got and not word.isalpha():
            plain = word.translate(LEET)
            got = self.lexicon.get(plain, 0.0)
        return got

    def row(self, text: str | None) -> list[float]:
        text = text or ""
        if not text.strip():
            return [0.0] * len(FEATURES)
        if len(self.memo) > 150_000:
            self.memo.clear()
        memo = self.memo
        words = _WORD.findall(text.lower())
        ws = [memo.get(w) for w in words]
        if None in ws:
            for i, w in enumerate(words):
                if ws[i] is None:
                    ws[i] = memo[w] = self.weight(w)
        masked = masked_words(text, words)
        masked_hit = 0
        for m in masked:
            plain = re.sub(r"[^\w@$!]+", "", m.lower()).translate(LEET)
            w = self.weight(plain)
            if w >= self.STRONG:
                masked_hit += 1
                ws.append(w)
        hits = [i for i, w in enumerate(ws) if w]
        strong = [i for i in hits if ws[i] >= self.STRONG]
        near = 0
        for i in strong:
            near += any(w in _SECOND for w in words[max(0, i - 4) : i + 5])
        n, chars = max(1, len(words)), len(text)
        mild = len(hits) - len(strong)
        return [
            math.log1p(n), len(strong) / n, math.log1p(len(strong)), float(bool(strong)), mild / n, math.log1p(mild),
            sum(ws[i] for i in strong), max((ws[i] for i in hits), default=0.0), near / max(1, len(strong)),
            sum(w in _SECOND for w in words) / n if near or strong else 0.0,
            sum(map(str.isupper, text)) / chars, len(_CAPS.findall(text)) / n,
            len(_PUNCT.findall(text)) / chars, text.count("!") / n, text.count("?") / n,
            len(masked) / n, float(masked_hit), stretches(text) / n, len(_DIGIT.findall(text)) / chars,
        ]

    def rows(self, texts: list[str | None]) -> np.ndarray:
        return np.array([self.row(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


_SECOND = frozenset(SECOND)
_PUNCT, _DIGIT = re.compile(r"[!-/:-@\[-`{-~]"), re.compile(r"[0-9]")


class Trees:
    """Boosted depth-limited trees on binned features with logistic loss."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, least: int = 15) -> None:
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least
        self.trees: list[list[tuple]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        for j, c in enumerate(x.T):  # a feature that is nearly always zero gets bins from its other values
            if len(self.edges[j]) < 4 and (nz := c[c > 0]).size:
                self.edges[j] = np.unique(np.concatenate(([0.0], np.quantile(nz, np.linspace(0, 1, 16)[:-1]) * (1 - 1e-9))))
        b = self._bin(x)
        p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base = math.log(p / (1 - p))
        f = np.full(len(y), self.base)
        for _ in range(self.rounds):
            s = 1 / (1 + np.exp(-f))
            tree, leaf = self._tree(b, y - s, s * (1 - s))
            self.trees.append(tree)
            f += leaf
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], 1)

    def _tree(self, b: np.ndarray, g: np.ndarray, h: np.ndarray):
        node, tree, out = np.zeros(len(g), np.int64), [], np.zeros(len(g))
        width = max(len(e) for e in self.edges) + 1
        open_nodes = {0}
        for depth in range(self.depth + 1):
            for k in sorted(open_nodes):
                rows = np.flatnonzero(node == k)
                gs, hs, best = g[rows].sum(), h[rows].sum(), (1e-6, None, None)
                if depth < self.depth:
                    for j in range(b.shape[1]):
                        c = b[rows, j]
                        gl = np.cumsum(np.bincount(c, g[rows], width))[:-1]
                        hl = np.cumsum(np.bincount(c, h[rows], width))[:-1]
                        nl = np.cumsum(np.bincount(c, minlength=width))[:-1]
                        gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                        gain[(nl < self.least) | (len(rows) - nl < self.least)] = -1
                        i = int(gain.argmax())
                        if gain[i] > best[0]:
                            best = (gain[i], j, i)
                if best[1] is None:
                    value = self.rate * gs / (hs + 1)
                    tree.append((k, -1, 0, value))
                    out[rows] = value
                else:
                    tree.append((k, best[1], best[2], 0.0))
                    node[rows] = 2 * k + 1 + (b[rows, best[1]] > best[2])
            open_nodes = set(np.unique(node)) - {t[0] for t in tree}
        return tree, out

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, f = self._bin(x), np.full(len(x), self.base)
        for tree in self.trees:
            node = np.zeros(len(x), np.int64)
            for k, j, cut_at, value in tree:
                rows = node == k
                if j < 0:
                    f[rows] += value
                else:
                    node[rows] = 2 * k + 1 + (b[rows, j] > cut_at)
        return f


def isotonic(s: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; rows of equal score are one point."""
    xs, at = np.unique(s, return_inverse=True)
    w, t = np.bincount(at).astype(float), np.bincount(at, y)
    blocks: list[list[float]] = []
    for x, a, b in zip(xs, t, w):
        blocks.append([a, b, x, x])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + a2[0], blocks[-1][1] + a2[1], blocks[-1][2], a2[3]]
    px = np.array([v for b in blocks for v in (b[2], b[3])])
    py = np.array([b[0] / b[1] for b in blocks for _ in (0, 1)])
    return px, py


class Model:
    def __init__(self, lexicon: dict[str, float], trees: Trees | None, px: np.ndarray, py: np.ndarray) -> None:
        self.features, self.trees, self.px, self.py = Featurizer(lexicon), trees, px, py

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.trees is None:
            return np.zeros(len(texts))
        return np.clip(np.interp(self.trees.raw(self.features.rows(texts)), self.px, self.py), 0, 1)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, every = Counter(), Counter()
    pack = lambda: pa.RecordBatch.from_arrays([pa.array(list(every)), pa.array([toxic[k] for k in every], pa.int64()), pa.array(list(every.values()), pa.int64())], names=["term", "toxic", "n"])
    for b in small(batches):
        for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            got = terms(text or "")
            every.update(got)
            if y:
                toxic.update(got)
            if len(every) > 200_000:
                yield pack()
                toxic.clear()
                every.clear()
    yield pack()


def _feature_rows(lexicon: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Featurizer(lexicon)
        for b in small(batches):
            x = f.rows(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), b.column(1).cast(pa.int32()), b.column(2).cast(pa.int32())], names=["x", "y", "fold"])

    return run


def fold(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)).cast("int")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from labelled rows outside fold 2; folds 1 and 3 give lexicon and trees, fold 0 the calibration."""
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).where("doc_id is not null and y is not null")
    lab = lab.groupBy("doc_id").agg(F.max("y").alias("y")).withColumn("fold", fold()).where("fold <> 2")
    n = lab.count()
    if n > sample:  # a share by hash first, so that few rows are sorted
        h = F.xxhash64("doc_id")
        lab = lab.where(F.pmod(h, F.lit(1_000_000)) < int(1_200_000 * sample / n) + 1000).orderBy(F.pmod(h, F.lit(1_000_000)), "doc_id").limit(sample)
    rows = doc_columns(docs).join(F.broadcast(lab), "doc_id")  # the sample's bound is checked above
    rows = rows.groupBy("doc_id", "y", "fold").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    rows = cut(rows.select(F.col("t.text").alias("text"), "y", "fold"), "op10-train")
    fit = rows.where("fold <> 0")
    sizes = {r.y: r.n for r in fit.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sum(n for y, n in sizes.items() if y), sizes.get(0, 0)
    if not toxic or not clean:
        return Model({}, None, np.zeros(1), np.zeros(1))
    counts = fit.select("text", "y").mapInArrow(_term_counts, "term string, toxic long, n long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    share = F.col("toxic") / toxic - (F.col("n") - F.col("toxic")) / clean
    top = counts.where(F.col("toxic") >= SUPPORT).withColumn("z", share / F.sqrt(F.col("n"))).orderBy(F.desc("z"), "term").limit(4 * LEXICON)
    lexicon = learn_lexicon([(r.term, r.toxic, r.n) for r in top.collect()], toxic, clean)
    got = rows.mapInArrow(_feature_rows(lexicon), "x array<double>, y int, fold int").toPandas()
    x, y, held = np.array(got.x.tolist()), got.y.to_numpy(float), (got.fold == 0).to_numpy()
    order = np.lexsort(np.column_stack([x, y, held]).T)  # the fit doesn't depend on how rows arrive
    x, y, held = x[order], y[order], held[order]
    trees = Trees().fit(x[~held], y[~held])
    side = held if held.any() else ~held
    return Model(lexicon, trees, *isotonic(trees.raw(x[side]), y[side]))


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            ids, texts = b.column(0), b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(model.score(texts))], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    return doc_columns(docs).mapInArrow(_scorer(model), "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    got = score(docs, train(docs, labels))
    return got.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _keeper(model: Model, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            ok = model.score(b.column(at).to_pylist()) < CUTOFF
            yield b.filter(pa.array(ok))

    return run


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a score of CUTOFF or more go; the model learns as in the query."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return docs.mapInArrow(_keeper(model, docs.columns.index("text")), docs.schema)
