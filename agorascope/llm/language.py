"""Language identification by a byte convolutional network, trained in numpy on labelled texts.

Bytes are embedded, filters of several widths slide over a fixed-length window, each filter's
largest response is kept, and a softmax layer tells the language. A text is cut into consecutive
windows, all of which are scored in batches; its languages' probabilities are the windows' means,
weighted by their bytes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agorascope.llm.common import map_batches, named

WINDOW, EMBEDDING, WIDTHS, FILTERS = 192, 8, (2, 3, 4), 8
WIDEST = max(WIDTHS)
#: Hard bounds of the labelled sample: texts of a language, characters of each, and texts of all languages together,
#: which are shared equally by languages beyond 200.
TEXTS_PER_LANGUAGE, SAMPLE_CHARS, MOST_TEXTS = 400, 1000, 80_000
#: All languages are learned; a column with more different values than this holds no languages.
MOST_LANGUAGES = 5000
#: Windows scored at a time.
CHUNK = 256
#: Word characters but decimal digits: letters, and a few numbers such as fractions, which ``has_letter`` sorts out.
LETTER = re.compile(r"[^\W\d_]")
UNDETERMINED = "und"


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def windows_of(data: bytes) -> np.ndarray:
    """Consecutive windows of all bytes, the last filled up with zeros, and room for the widest filter."""
    n = -(-len(data) // WINDOW)
    out = np.zeros((n, WINDOW + WIDEST - 1), np.uint8)
    out[:, :WINDOW] = np.frombuffer(data.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)
    out[:-1, WINDOW:] = out[1:, : WIDEST - 1]
    return out


@dataclass
class ByteNetwork:
    """All widths are columns of one filter matrix over the widest width; ``mask`` zeroes what narrower ones don't see."""

    languages: list[str]
    seed: int = 3
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        rng, n = np.random.default_rng(self.seed), FILTERS * len(WIDTHS)
        self.mask = np.concatenate([np.repeat((np.arange(WIDEST) < w)[:, None], FILTERS, 1) for w in WIDTHS], 1).repeat(EMBEDDING, 0).astype(np.float32)
        if not self.weights:
            made = {"embedding": rng.normal(0, 0.5, (256, EMBEDDING)), "filters": rng.normal(0, 0.3, (WIDEST * EMBEDDING, n)), "bias": np.zeros(n), "out": rng.normal(0, 0.3, (n, len(self.languages))), "out_bias": np.zeros(len(self.languages))}
            self.weights = {k: v.astype(np.float32) for k, v in made.items()}

    def _columns(self, windows: np.ndarray) -> np.ndarray:
        flat = self.weights["embedding"][windows].reshape(len(windows), -1)
        n, step = flat.shape[0], flat.strides
        return np.lib.stride_tricks.as_strided(flat, (n, WINDOW, WIDEST * EMBEDDING), (step[0], EMBEDDING * step[1], step[1]))

    def forward(self, windows: np.ndarray, positions: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """(probabilities, pooled responses, their positions where asked for)."""
        w = self.weights
        response = np.ascontiguousarray(self._columns(windows)).reshape(-1, WIDEST * EMBEDDING) @ (w["filters"] * self.mask)
        response = response.reshape(len(windows), WINDOW, -1)
        at = response.argmax(1) if positions else None
        pooled = np.maximum(response.max(1) + w["bias"], 0)
        logits = pooled @ w["out"] + w["out_bias"]
        e = np.exp(logits - logits.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True), pooled, at

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01) -> ByteNetwork:
        """Adam on the cross-entropy; only each filter's pooled position carries a gradient."""
        rng, w = np.random.default_rng(self.seed), self.weights
        first, second, t = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
        for _ in range(epochs):
            for own in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // batch)):
                x, y = windows[own], labels[own]
                p, pooled, at = self.forward(x, positions=True)
                p[np.arange(len(y)), y] -= 1
                p /= len(y)
                d = (p @ w["out"].T) * (pooled > 0)
                seen = self._columns(x)[np.arange(len(x))[:, None], at]  # window, filter, inputs
                back = d[:, :, None] * (w["filters"] * self.mask).T
                grads = {"out": pooled.T @ p, "out_bias": p.sum(0), "bias": d.sum(0), "filters": np.einsum("bf,bfi->if", d, seen) * self.mask, "embedding": np.zeros_like(w["embedding"])}
                bytes_at = x[np.arange(len(x))[:, None, None], at[:, :, None] + np.arange(WIDEST)]
                np.add.at(grads["embedding"], bytes_at.ravel(), back.reshape(-1, EMBEDDING))
                t += 1
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    w[k] -= (rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
        return self

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and probability of each whole text."""
        data = [t.encode() if t and has_letter(t) else b"" for t in texts]
        totals = np.zeros((len(texts), len(self.languages)))
        for start, stop in _groups([len(d) for d in data]):
            x = np.concatenate([windows_of(d) for d in data[start:stop]])
            counts = np.array([-(-len(d) // WINDOW) for d in data[start:stop]])
            owner = np.repeat(np.arange(start, stop), counts)
            size = np.full(len(x), WINDOW)
            ends = np.cumsum(counts)[counts > 0] - 1
            size[ends] = [len(d) - (-(-len(d) // WINDOW) - 1) * WINDOW for d in data[start:stop] if d]
            for i in range(0, len(x), CHUNK):
                p = self.forward(x[i : i + CHUNK])[0] * size[i : i + CHUNK, None]
                np.add.at(totals, owner[i : i + CHUNK], p)
        lengths = np.array([max(1, len(d)) for d in data])
        means, best = totals / lengths[:, None], totals.argmax(1)
        return [self.languages[b] if d else UNDETERMINED for b, d in zip(best, data, strict=True)], [min(1.0, float(means[i, b])) if data[i] else 0.0 for i, b in enumerate(best)]


def _groups(lengths: list[int], most: int = 1 << 20):
    """Ranges of texts with about ``most`` bytes together; a longer text is a range of its own."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if total:
        yield start, len(lengths)


def held_out(id: str = "doc_id") -> F.Column:
    """Documents that nothing is learned from; a null id is not one of them, but has no part in the training either."""
    return F.coalesce(F.crc32(named(id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, id: str, text: str, lang: str, per_language: int) -> list:
    """At most ``per_language`` passages of each language from texts outside the held-out part, those with the least hashes.

    Repeated rows, by id and text, count once, so no id or text can bring more to the driver. With so many languages that all
    their passages were more than ``MOST_TEXTS``, each has fewer; none is left out. Rows with a null id, text or language
    are not looked at.
    """
    known = docs.select(named(id).alias("id"), named(text).cast("string").alias("t"), named(lang).cast("string").alias("lang")).where(F.col("id").isNotNull() & F.col("t").isNotNull() & F.col("lang").isNotNull() & ~held_out("id"))
    known = known.withColumn("h", F.xxhash64("id", "t"))
    counts = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{lang} has more than {MOST_LANGUAGES} different values, so it can't hold languages")
    if not counts:
        return []
    most = max(1, min(per_language, MOST_TEXTS // len(counts)))
    # three times as many as wanted come through, nearly never fewer than wanted; of these the least hashes are taken
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(int(10_000_000 * min(1.0, 3 * (most + 10) / r["n"]))))])
    some = known.where(F.pmod("h", F.lit(10_000_000)) < F.element_at(share, F.col("lang")))
    start = F.pmod(F.xxhash64("h", F.lit(1)), F.greatest(F.lit(1), F.length("t") - SAMPLE_CHARS)).cast("int") + 1
    once = some.groupBy("lang", "h").agg(F.max(F.substring("t", start, F.lit(SAMPLE_CHARS))).alias("t"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return once.withColumn("place", place).where(F.col("place") <= most).select("lang", "t").orderBy("lang", "h").collect()


def train(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = TEXTS_PER_LANGUAGE) -> ByteNetwork | None:
    """A network for the languages of the labelled sample; None without labelled texts."""
    rows = [r for r in labelled_sample(docs, id, text, lang, per_language) if has_letter(r["t"])]
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    rng, x, y = np.random.default_rng(1), [], []
    for r in rows:
        data = r["t"].encode()
        short = data[: int(rng.integers(8, WINDOW))]  # texts shorter than a window occur as well
        for part in (data, short):
            found = windows_of(part)
            x.append(found)
            y += [languages.index(r["lang"])] * len(found)
    return ByteNetwork(languages).fit(np.concatenate(x), np.array(y))


def identify(docs: DataFrame, network: ByteNetwork | None = None, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row.

    Null texts and texts without a letter are ``und`` with score 0, and so is everything if there
    are no labelled texts to learn from. Repeated rows each come back, null ids stay, ids may be of any
    type, other columns are not read, an empty table gives an empty table. Texts are scored whole, whatever
    their length.
    """
    network = network or train(docs, id, text, lang)

    def setup():
        def work(texts):
            names, scores = network.predict(texts) if network else ([UNDETERMINED] * len(texts), [0.0] * len(texts))
            return None, {"lang_pred": names, "score": scores}

        return work

    rows = docs.select(named(id).alias("id"), held_out(id).alias("held_out"), named(text).cast("string").alias("text"))
    return map_batches(rows, setup, [("lang_pred", "string"), ("score", "double")], carried=2).withColumnRenamed("id", id)
