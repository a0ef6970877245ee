"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

Texts are sentences of **units**: words, and runs of single characters written apart
("i d i o t") joined to one.  The kernel compares units by their subsequences of three
characters, gaps allowed (a span of at most SPAN characters, each gap costing DECAY),
so insults with inserted or left-out characters stay close.  Landmarks are units of the
training sample; the Nystroem map K(x, Z) K(Z, Z)^(-1/2) turns the kernel into a short
vector, and a linear SVM is trained on it.  A sentence is as toxic as its worst unit, a
document as its worst sentence; only documents have labels, so which units of toxic
sentences are the insults is learned in rounds (multi-instance): first those that
clean sentences never hold (more often than chance explains), then those that the classifier itself finds, against the
clean units that it confuses most.  Platt scaling on other labelled rows makes the score.

The trained decision is linear in the subsequence weights, so it folds into one table of
bounded size and scoring is a narrow pass over all documents: no shuffle, whole texts,
each distinct unit of a chunk scored once.

Training reads a bounded, documented sample of labelled rows (ROWS per class, the
smallest by a hash of the id) and brings at most a few thousand units (UNITS per list) to
the driver; the statistics of units are counted by Spark.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat.llm.common import chunked, give_back, stored, text_of

#: Labelled rows of either class that the classifier is fitted on.
ROWS = 3000
#: Units in each list that the driver fits on.
UNITS = 3000
#: Nystroem landmarks.
LANDMARKS = 384
#: Characters between the first and the last of a subsequence; longer units are
#: covered by overlapping windows.
SPAN, WINDOW, DECAY = 5, 24, 0.5
#: Share of the first list of insults that chance may explain.
CHANCE = 0.02
#: Share of the clean units that may score above a unit that joins the insults later.
CLEAN_ABOVE = 0.0005
#: Characters fold into so many symbols; the table has SYMBOLS ** 3 weights.
SYMBOLS = 97
MARGIN = "__margin"
#: Bytes of text that a task scores at once (its lists of words take some ten times that), and units.
SCORE_BYTES, SCORE_UNITS = 2 << 20, 10_000
SENTENCE = re.compile(r"[.!?\n]+")
EDGES = ".,;:!?\"'()[]{}|*%#&$-_<>/\\~`^+="
GAPS = [(near, far, DECAY ** (far - 2)) for far in range(2, SPAN + 1) for near in range(1, far)]


@dataclass
class Model:
    """Weights of subsequences, the bias, and Platt's slope and offset.  Without both
    classes among the labels the score is their rate (0.5 without labels)."""

    table: np.ndarray = field(default_factory=lambda: np.zeros(SYMBOLS ** 3, np.float32))
    bias: float = 0.0
    slope: float = 0.0
    offset: float = 0.0

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


# ---- units and kernel ------------------------------------------------------------------------

def unit_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All units of some texts, and the number of the text that each is of."""
    lists = pc.ascii_split_whitespace(pc.utf8_lower(texts.cast(pa.large_string())))
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    words = pc.utf8_trim(lists.flatten(), characters=EDGES)
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    single = length == 1
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (single & True).astype(np.int8), [0]])))
    runs = [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= 3]
    joined, of = [], []
    for a, b in runs:                         # runs of single characters, within a text
        for part in np.split(np.arange(a, b), np.flatnonzero(np.diff(owner[a:b])) + 1):
            if len(part) >= 3:
                joined.append("".join(words.slice(part[0], len(part)).to_pylist()))
                of.append(owner[part[0]])
    keep = length > 1
    words, owner = words.filter(pa.array(keep)), owner[keep]
    if joined:
        words = pa.concat_arrays([words, pa.array(joined, pa.large_string())])
        owner = np.concatenate([owner, of])
    return words, owner


def _matrix(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all windows with edge marks, padded by 0, and the unit of each window."""
    pieces, owner = [], []
    for i, unit in enumerate(units):
        for at in range(0, max(1, len(unit) - WINDOW // 2), WINDOW // 2) if len(unit) > WINDOW else (0,):
            pieces.append(f"^{unit[at:at + WINDOW]}$".replace("\0", "?"))
            owner.append(i)
    codes = np.array(pieces, f"U{WINDOW + 2}").view(np.uint32).reshape(len(pieces), WINDOW + 2)
    codes = codes[:, :max(map(len, pieces), default=1)]
    return np.where(codes > 0, codes % (SYMBOLS - 1) + 1, 0).astype(np.int32), np.array(owner, np.int64)


def _subsequences(symbols: np.ndarray):
    """(table places, valid, weight) for every gap pattern."""
    width = symbols.shape[1]
    for near, far, weight in GAPS:
        if far < width:
            last = symbols[:, far:]
            yield (symbols[:, :-far] * SYMBOLS + symbols[:, near:width - far + near]) * SYMBOLS + last, last > 0, weight


def margins(units: list[str], model: Model) -> np.ndarray:
    out = np.full(len(units), -np.inf)
    for at in range(0, len(units), SCORE_UNITS):
        symbols, owner = _matrix(units[at:at + SCORE_UNITS])
        total, norm = np.zeros(len(symbols), np.float32), np.zeros(len(symbols), np.float32)
        for places, valid, weight in _subsequences(symbols):
            total += weight * (model.table[places] * valid).sum(axis=1)
            norm += weight * weight * valid.sum(axis=1)
        np.maximum.at(out[at:at + SCORE_UNITS], owner, total / np.sqrt(np.maximum(norm, 1e-9)) + model.bias)
    return out


def _vectors(units: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse normalised subsequence vectors of units (their first windows)."""
    symbols, owner = _matrix([u[:WINDOW] for u in units])
    parts = [(p, v, np.full(p.shape, w)) for p, v, w in _subsequences(symbols)]
    places = np.concatenate([p for p, _, _ in parts], axis=1)
    valid = np.concatenate([v for _, v, _ in parts], axis=1)
    weight = np.concatenate([w for _, _, w in parts], axis=1)
    out = []
    for p, v, w in zip(places, valid, weight):
        at, inverse = np.unique(p[v], return_inverse=True)
        out.append((at, np.bincount(inverse, weights=w[v], minlength=len(at)) / max(1e-9, np.sqrt((w[v] ** 2).sum()))))
    return out


# ---- training --------------------------------------------------------------------------------

def fit_svm(positive: list[str], negative: list[str], seed: int = 42, cost: float = 10.0, hard: list[str] = ()) -> Model:
    """Nystroem map on landmarks of both classes, then a linear SVM (squared hinge loss,
    classes balanced, Newton steps), folded into a table of subsequence weights.  ``hard``:
    negatives, the most confused first, that a third of the landmarks are taken from."""
    rng = np.random.default_rng(seed)
    marks = [*rng.permutation(positive)[:LANDMARKS // 3], *hard[:LANDMARKS // 3]]
    marks += [*rng.permutation(negative)[:LANDMARKS - len(marks)]]
    landmark = _vectors([str(m) for m in marks])
    used = np.unique(np.concatenate([p for p, _ in landmark]))
    z = np.zeros((len(marks), len(used)))
    for row, (p, w) in zip(z, landmark):
        row[np.searchsorted(used, p)] = w
    values, vectors = np.linalg.eigh(z @ z.T)
    half = vectors[:, values > 1e-8] / np.sqrt(values[values > 1e-8])

    units = [*positive, *negative]
    kernel = np.zeros((len(units), len(marks)))
    for row, (p, w) in zip(kernel, _vectors(units)):
        at = np.minimum(np.searchsorted(used, p), len(used) - 1)
        hit = used[at] == p
        row[:] = z[:, at[hit]] @ w[hit]
    x = np.column_stack([kernel @ half, np.ones(len(units))])
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    share = cost * np.where(y > 0, 0.5 / max(1, len(positive)), 0.5 / max(1, len(negative))) * len(y)
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        slack = np.maximum(0, 1 - y * (x @ beta))
        active = slack > 0
        gradient = ridge @ beta - 2 * x[active].T @ (share * y * slack)[active]
        step = np.linalg.solve(ridge + 2 * x[active].T @ (x[active] * share[active, None]), gradient)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    table = np.zeros(SYMBOLS ** 3, np.float32)
    table[used] = (half @ beta[:-1]) @ z
    return Model(table=table, bias=float(beta[-1]))


def platt(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, with Platt's smoothed targets and both
    classes weighing the same."""
    n, p = int((label == 0).sum()), int((label == 1).sum())
    if not n or not p:
        return 4.0, 0.0
    target = np.where(label == 1, (p + 1) / (p + 2), 1 / (n + 2))
    weight = np.where(label == 1, 0.5 / p, 0.5 / n) * len(label)
    x, w = np.column_stack([margin, np.ones(len(margin))]), np.array([1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (weight * q * (1 - q))[:, None]) + 1e-3 * np.eye(2),
                               x.T @ (weight * (q - target)) + 1e-3 * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.1)), float(w[1])


def _sentence_units(batches):
    """Labelled texts -> (context, unit, toxic): every unit of every sentence with a
    number for its neighbours.  Copies and near copies of a sentence have the same
    neighbours nearly everywhere, an insult has others each time."""
    for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):     # bounds the lists of words
        sentences, toxic = [], []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            own = {s for s in map(str.strip, SENTENCE.split(text.lower())) if s}
            sentences.extend(own)
            toxic.extend([label] * len(own))
        units, owner = unit_lists(pa.array(sentences, pa.large_string()))
        words = units.to_pylist()
        near = lambda i, j: words[j] if 0 <= j < len(words) and owner[j] == owner[i] else ""
        number = np.fromiter((xxhash.xxh3_64_intdigest(f"{near(i, i - 1)} {near(i, i + 1)}") for i in range(len(words))),
                             np.uint64, len(words)).view(np.int64)
        yield pa.RecordBatch.from_pydict({
            "context": number, "unit": units.cast(pa.string()), "toxic": np.array(toxic, np.int32)[owner]})
    batch = units = words = sentences = near = None
    give_back()


def _unit_margins(model):
    def run(batches):
        for batch in batches:
            got = margins(batch.column("unit").to_pylist(), model.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], names=[*batch.schema.names, "margin"])
        give_back()
    return run


def _document_margins(texts: pa.Array, model: Model) -> np.ndarray:
    units, owner = unit_lists(texts)
    out = np.full(len(texts), model.bias - 1.0)                 # texts without units
    coded = units.dictionary_encode()
    if len(units):
        np.maximum.at(out, owner, margins(coded.dictionary.to_pylist(), model)[coded.indices.to_numpy()])
    return out


def _append_margins(model, column: str):
    def run(batches):
        for _, t in chunked(batches, SCORE_BYTES, column):
            texts = pc.fill_null(t.column(column).combine_chunks(), "")
            yield from t.append_column(MARGIN, pa.array(_document_margins(texts, model.value))).to_batches()
    return run


def with_margin(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of the documents and the classifier's margin of their whole text."""
    schema = T.StructType([*docs.schema.fields, T.StructField(MARGIN, T.DoubleType())])
    return docs.mapInArrow(_append_margins(docs.sparkSession.sparkContext.broadcast(model), text_col), schema)


def score_of(model: Model) -> Column:
    """Platt's score of the margin column."""
    line = F.lit(model.slope) * F.col(MARGIN) + F.lit(model.offset)
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), line))))


def _least(counted: DataFrame) -> int:
    """How often an item of toxic sentences alone must occur so that at most CHANCE of such
    items would be expected if the items fell on toxic and clean sentences at random."""
    toxic, clean = counted.agg(F.coalesce(F.sum("p"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    by_times = counted.groupBy((F.col("p") + F.col("n")).alias("times")).agg(
        F.count(F.lit(1)).alias("all"), F.count_if(F.col("n") == 0).alias("only")).where("only > 0")
    expected = F.col("all") * F.pow(F.lit(toxic / max(1, toxic + clean)), F.col("times"))
    least = by_times.where(expected <= CHANCE * F.col("only")).agg(F.min("times")).first()[0]
    return least if least is not None else 1 << 60


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", rows: int = ROWS, units: int = UNITS) -> Model:
    """Fit on the labelled rows where ``usable`` (an expression of the id) holds."""
    spark = docs.sparkSession
    known = labels.where(usable & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.max(F.col(label_col).cast("int")).alias("toxic"))
    order = F.xxhash64("id", F.lit(42))
    chosen = [r for label in (1, 0) for r in known.where(F.col("toxic") == label).orderBy(order, "id").limit(rows).collect()]
    counts = np.bincount([r["toxic"] for r in chosen], minlength=2)
    if not counts.all():
        rate = counts[1] / counts.sum() if counts.sum() else 0.5
        return Model(offset=30.0 if rate == 1 else -30.0 if rate == 0 else 0.0)
    # at most 2 x rows ids: a bounded broadcast
    sample = spark.createDataFrame(chosen, "id long, toxic int").withColumn("fold", F.pmod(F.shiftright(order, 9), F.lit(4)))
    texts = stored(docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).join(
        F.broadcast(sample), "id").select("fold", "toxic", "text"), "toxicity-sample")

    # a context that a clean document holds too is clean; copies of a context count once
    heard = texts.where("fold > 0").select("text", "toxic").mapInArrow(
        _sentence_units, "context long, unit string, toxic int").groupBy("unit", "context").agg(
        F.min("toxic").alias("toxic"))
    found = stored(heard.groupBy("unit").agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n")),
                   "toxicity-units")
    by_hash = F.xxhash64("unit")

    def top(rows, *order):
        return [r["unit"] for r in rows.orderBy(*order, by_hash, "unit").limit(units).collect()]

    def only_of(counted: DataFrame) -> DataFrame:
        return counted.where("p > 0 AND n = 0")

    # units that only toxic sentences hold, so often that chance explains few of them
    positive = top(only_of(found).where(F.col("p") >= _least(found)), F.desc("p"))
    clean = sorted({*top(found.where("n > 0"), F.desc("n")), *top(found.where("n > 0"))})
    if not positive or not clean:
        return Model(offset=-30.0)
    model = fit_svm(positive, clean)
    for _ in range(2):                      # what the classifier finds, against what it confuses
        scored = found.mapInArrow(_unit_margins(spark.sparkContext.broadcast(model)),
                                  "unit string, p long, n long, margin double")
        scored = stored(scored, "toxicity-scored")
        # a unit joins the insults if it scores above nearly all clean units
        cut = scored.where("n > 0").agg(F.percentile_approx("margin", F.lit(1 - CLEAN_ABOVE), F.lit(100_000))).first()[0]
        positive = sorted({*positive, *top(only_of(scored).where(F.col("margin") > max(0.5, cut)), F.desc("p"), F.desc("margin"))})
        hard = top(scored.where("n > 0 AND margin > -1"), F.desc("margin"))
        clean = sorted({*clean, *hard})
        model = fit_svm(positive, clean, hard=hard)
    held = [(r[MARGIN], r["toxic"]) for r in with_margin(
        texts.where("fold = 0").select("toxic", "text"), model).select("toxic", MARGIN).collect()]
    if held:
        margin, label = (np.array(x, float) for x in zip(*held))
        model.slope, model.offset = platt(margin, label)
    else:
        model.slope, model.offset = 4.0, 0.0
    return model


def toxicity_scores(docs: DataFrame, model: Model, columns: list[str], text_col: str = "text",
                    threshold: float = 0.7) -> DataFrame:
    """``columns`` of the documents, score (0 to 1) and predicted (1 from ``threshold`` on).

    Null and empty texts get the score of a text without any unit.  Repeated rows
    are scored each; an empty table gives an empty result; only the text is an input.
    """
    own = docs.select(*[c for c in columns if c != text_col], F.col(text_col).cast("string"))
    scored = with_margin(own, model, text_col)
    score = score_of(model)
    return scored.select(*columns, score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
