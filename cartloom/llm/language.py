"""Language of texts by a byte convolutional network.

The network sees windows of ``WINDOW`` bytes. Bytes are embedded; filters of several widths slide
over them; each filter's highest value in the window goes through a rectifier to a softmax over the
learned languages. It is trained in numpy by Adam, with gradients that reach only the places of the
highest values. As every filter sees one byte per offset, embedding and filter are folded into one
table per offset, so a convolution is a few table look-ups.

Applied, a text is cut into windows over all its bytes, which overlap by the widest filter, so that
each place is seen once. The language with the highest mean log probability over the windows is
predicted; its mean probability is the score.

Training takes a sample of at most ``sample`` labelled texts and ``windows`` windows of each (both
parameters), cut out before they reach the driver. Languages weigh equally, whatever their share.

Edge cases: texts that are null, empty or without a letter get ``und`` with score 0, as do all texts
if nothing is labelled; a text shorter than a window is filled up with zero bytes; repeated rows get
equal results; a very long text is read whole, some windows at a time; empty tables give no rows;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.tables import bounded_sample

WINDOW, WIDTHS, FILTERS, EMBEDDING = 128, (3, 4, 5), 16, 8
#: From one window to the next: the widest filter sees every place in one of them.
STRIDE = WINDOW - max(WIDTHS) + 1
UNKNOWN = "und"


class ByteNetwork:
    def __init__(self, classes: list[str], seed: int = 13):
        generator = np.random.default_rng(seed)
        draw = lambda scale, *shape: generator.normal(0, scale, shape).astype(np.float32)
        self.classes = classes
        self.weights = {"embedding": draw(0.5, 256, EMBEDDING)}
        for w in WIDTHS:
            self.weights[f"filter{w}"] = draw((w * EMBEDDING) ** -0.5, w, EMBEDDING, FILTERS)
        self.weights["bias"] = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.weights["dense"] = draw(0.1, len(WIDTHS) * FILTERS, len(classes))
        self.weights["prior"] = np.zeros(len(classes), np.float32)

    def tables(self) -> list[np.ndarray]:
        """Per width: what a byte at each offset adds to each filter."""
        return [self.weights["embedding"] @ self.weights[f"filter{w}"] for w in WIDTHS]

    def highest(self, x: np.ndarray, tables: list[np.ndarray]) -> Iterator[np.ndarray]:
        """Per width, the values of the filters at every place of every window."""
        for table in tables:
            places = x.shape[1] - len(table) + 1
            values = np.take(table[0], x[:, :places], axis=0)
            for offset in range(1, len(table)):
                values += np.take(table[offset], x[:, offset : offset + places], axis=0)
            yield values

    def log_probabilities(self, x: np.ndarray, tables: list[np.ndarray] | None = None) -> np.ndarray:
        """(windows, classes), for windows of byte values; a few windows at a time stay in the cache."""
        tables, out = tables or self.tables(), []
        for start in range(0, len(x), 64):
            part = x[start : start + 64].astype(np.intp)
            pooled = np.concatenate([v.max(axis=1) for v in self.highest(part, tables)], axis=1)
            out.append(np.maximum(pooled + self.weights["bias"], 0) @ self.weights["dense"] + self.weights["prior"])
        scores = np.concatenate(out) if out else np.zeros((0, len(self.classes)), np.float32)
        scores -= scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted mean cross-entropy."""
        w, x = self.weights, x.astype(np.intp)
        rows, tops, pooled = np.arange(len(x))[:, None], [], []
        for values in self.highest(x, self.tables()):
            tops.append(values.argmax(axis=1))
            pooled.append(values[rows, tops[-1], np.arange(FILTERS)])
        hidden = np.maximum(np.concatenate(pooled, axis=1) + w["bias"], 0)
        scores = hidden @ w["dense"] + w["prior"]
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p *= (weight / weight.sum())[:, None]
        back = (p @ w["dense"].T) * (hidden > 0)
        out = {"dense": hidden.T @ p, "prior": p.sum(axis=0), "bias": back.sum(axis=0), "embedding": np.zeros_like(w["embedding"])}
        for i, width in enumerate(WIDTHS):
            mine, filters = back[:, i * FILTERS : (i + 1) * FILTERS], w[f"filter{width}"]
            out[f"filter{width}"] = np.empty_like(filters)
            for offset in range(width):
                cells = x[rows, tops[i] + offset] * FILTERS + np.arange(FILTERS)
                table = np.bincount(cells.ravel(), mine.ravel(), 256 * FILTERS).reshape(256, FILTERS).astype(np.float32)
                out[f"filter{width}"][offset] = w["embedding"].T @ table
                out["embedding"] += table @ filters[offset].T
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 13) -> ByteNetwork:
        weight = 1 / np.maximum(np.bincount(y, minlength=len(self.classes)), 1)[y]
        generator, step = np.random.default_rng(seed), 0
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}
        for epoch in range(epochs):
            order = generator.permutation(len(x))
            for start in range(0, len(x), batch):
                part, step = order[start : start + batch], step + 1
                for name, g in self.gradients(x[part], y[part], weight[part]).items():
                    first, second = moments[name]
                    first += 0.1 * (g - first)
                    second += 0.01 * (g * g - second)
                    size = rate * (1 - epoch / epochs)
                    self.weights[name] -= (size * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self


def cut_windows(text: bytes) -> np.ndarray:
    """(windows, WINDOW) byte values over the whole text."""
    n = max(1, -(-(len(text) - (WINDOW - STRIDE)) // STRIDE))
    filled = np.zeros((n - 1) * STRIDE + WINDOW, np.uint8)
    filled[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(filled, WINDOW)[::STRIDE]


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that nothing is learned from: a third of the ids. A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))), F.lit(3)) == 1


def train_language(
    labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", sample: int = 6000, windows: int = 2
) -> ByteNetwork | None:
    """A network from a bounded sample of the labelled texts; None without any."""
    known = labelled.select(
        F.col(id_column).cast("string").alias("id"), F.col(label_column).cast("string").alias("label"), F.col(text_column).cast("string").alias("words")
    ).where("label is not null and words rlike '\\\\p{L}'")
    chosen = bounded_sample(known, sample, "id").withColumn("body", F.col("words").cast("binary"))
    cut = [F.expr(f"substring(body, cast(1 + pmod(xxhash64(id, {j}), greatest(1, length(body) - {WINDOW - 1})) as int), {WINDOW})") for j in range(windows)]
    table = chosen.select("label", F.array(*cut).alias("cuts")).toArrow()  # at most ``sample`` rows of a few windows
    rows = sorted((r["label"], [bytes(c) for c in r["cuts"]]) for r in table.to_pylist())
    if not rows:
        return None
    classes = sorted({label for label, _ in rows})
    x = np.concatenate([cut_windows(c)[:1] for _, cuts in rows for c in cuts])
    y = np.array([classes.index(label) for label, cuts in rows for _ in cuts])
    return ByteNetwork(classes).fit(x, y)


def _predict(network: ByteNetwork):
    """Batched over texts: windows of many short texts, or a part of those of a long one, at a time."""
    schema = pa.schema([("id", pa.int64()), ("held", pa.bool_()), ("label", pa.string()), ("score", pa.float64())])
    classes = np.array(network.classes, object)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables()
        for batch in batches:
            body, known = batch.column(batch.schema.get_field_index("body")), batch.column(batch.schema.get_field_index("known")).to_pylist()
            logs, means = np.zeros((batch.num_rows, len(classes))), np.zeros((batch.num_rows, len(classes)))
            held: list[np.ndarray] = []
            owners: list[int] = []

            def judge() -> None:
                owner = np.repeat(owners, [len(h) for h in held])
                found = network.log_probabilities(np.concatenate(held), tables)
                for i in range(len(classes)):
                    logs[:, i] += np.bincount(owner, found[:, i], batch.num_rows)
                    means[:, i] += np.bincount(owner, np.exp(found[:, i]), batch.num_rows)
                held.clear()
                owners.clear()

            counts, size = np.ones(batch.num_rows), 0
            for i in range(batch.num_rows):
                if not known[i]:
                    continue
                windows = cut_windows(body[i].as_py())
                counts[i] = len(windows)
                for start in range(0, len(windows), 4096):
                    held.append(windows[start : start + 4096])
                    owners.append(i)
                    size += len(held[-1])
                    if size >= 4096:
                        judge()
                        size = 0
            if held:
                judge()
            best = logs.argmax(axis=1)
            score = np.clip(means[np.arange(batch.num_rows), best] / counts, 0, 1)
            known = np.array(known, bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.where(known, classes[best], UNKNOWN), pa.string()), pa.array(np.where(known, score, 0.0))],
                schema=schema,
            )

    return run, "id long, held boolean, label string, score double"


def predict_language(
    docs: DataFrame, network: ByteNetwork | None, id_column: str = "doc_id", text_column: str = "text", held: Column | None = None
) -> DataFrame:
    """(id, held_out, lang_pred, score) per row; only the text decides."""
    text = F.col(text_column).cast("string")
    given = docs.select(
        F.col(id_column).cast("long").alias("id"),
        (held_out(id_column) if held is None else held).alias("held"),
        text.cast("binary").alias("body"),
        F.coalesce(text.rlike("\\p{L}"), F.lit(False)).alias("known"),
    )
    if network is None:
        found = given.select("id", "held", F.lit(UNKNOWN).alias("label"), F.lit(0.0).alias("score"))
    else:
        found = given.mapInArrow(*_predict(network))
    return found.select(F.col("id").alias(id_column), F.col("held").alias("held_out"), F.col("label").alias("lang_pred"), "score")
