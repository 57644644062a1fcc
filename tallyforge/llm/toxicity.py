"""Toxicity scores from a small convolutional text classifier, trained in numpy.

Words and their beginnings are hashed to embeddings; filters of several widths slide over them,
each keeps its largest activation in the text, and a logistic layer adds these up. Thresholds
are calibrated by language - guessed from function words of the text itself, never from a
column - and moved to 0.5.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
import pyspark.sql.types as T
from pyspark.sql import DataFrame

from tallyforge.session import checkpointed

from .textops import ALNUM, Words, free_name, pieces

#: At most so many labelled texts, and so many of their words, are fetched to train on.
SAMPLE_ROWS = 12_000
SAMPLE_WORDS = 6_000_000

# Fixed function words that mark a language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are with as be at this by".split(),
    "de": "der die und das ist nicht den von zu mit sich des auf für dem ein".split(),
    "fr": "le la les des et un une du est dans que qui pour pas sur au".split(),
    "es": "el los las y del que se por con una para su al lo como es".split(),
}
LANGUAGES = [*FUNCTION_WORDS, "other"]


def _word_hashes(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    return Words(raw, np.array([0, len(raw)]), ALNUM).hashes()


#: Besides its own bucket a word has one for each of these beginnings (bytes), so that unseen
#: words share what is learnt about their stem.
PREFIXES = (4, 5, 6, 7)
_BLOCK_WORDS = 100_000


def features(words: Words) -> np.ndarray:
    """A row of hashes per word: of the word and of its beginnings."""
    return np.stack([words.hashes(), *[words.hashes(n) for n in PREFIXES]], axis=1)


@dataclass
class Model:
    """Weights of the classifier. ``floor`` is the threshold on the raw score by language."""

    bits: int = 15
    depth: int = 12
    filters: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    seed: int = 7
    embedding: np.ndarray = field(init=False)
    kernel: dict[int, np.ndarray] = field(init=False)
    bias: dict[int, np.ndarray] = field(init=False)
    out: np.ndarray = field(init=False)
    offset: float = 0.0
    #: False where there was no text to train on: every score is 0.5 then.
    trained: bool = True
    floor: np.ndarray = field(init=False)

    def __post_init__(self):
        r = np.random.default_rng(self.seed)
        self.embedding = r.normal(0, 0.1, (1 << self.bits, self.depth)).astype(np.float32)
        self.kernel = {w: r.normal(0, 0.3, (w, self.depth, self.filters)).astype(np.float32) for w in self.widths}
        self.bias = {w: np.zeros(self.filters, np.float32) for w in self.widths}
        self.out = r.normal(0, 0.3, len(self.widths) * self.filters).astype(np.float32)
        self.floor = np.zeros(len(LANGUAGES))
        marks = [_word_hashes(FUNCTION_WORDS[x]) for x in LANGUAGES[:-1]]
        self.mark_hash = np.concatenate(marks)
        self.mark_language = np.repeat(np.arange(len(marks)), [len(m) for m in marks])
        order = np.argsort(self.mark_hash)
        self.mark_hash, self.mark_language = self.mark_hash[order], self.mark_language[order]

    def buckets(self, hashes: np.ndarray) -> np.ndarray:
        """The leading bits of word hashes, or of what is left of them in 16 bits."""
        return (hashes >> hashes.dtype.type(8 * hashes.itemsize - self.bits)).astype(np.int32)

    def languages(self, hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The language with most function words in each text; without any, "other"."""
        slot = np.minimum(np.searchsorted(self.mark_hash, hashes), len(self.mark_hash) - 1)
        places = np.flatnonzero(self.mark_hash[slot] == hashes)
        text = np.searchsorted(row, places, "right") - 1
        counts = np.zeros((len(row) - 1, len(LANGUAGES)))
        np.add.at(counts, (text, self.mark_language[slot[places]]), 1)
        counts[:, -1] = 0.5
        return counts.argmax(axis=1)

    def embed(self, bucket: np.ndarray) -> np.ndarray:
        total = self.embedding[bucket[:, 0]]
        for k in range(1, bucket.shape[1]):
            total += self.embedding[bucket[:, k]]
        return total

    def convolved(self, embedded: np.ndarray, width: int) -> np.ndarray:
        """Responses of the filters of one width from each word on."""
        n = len(embedded) - width + 1
        value = embedded[:n] @ self.kernel[width][0]
        for k in range(1, width):
            value += embedded[k : k + n] @ self.kernel[width][k]
        return value

    def pooled(self, bucket: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The largest activation of each filter in each text, 0 where no window fits. Works on
        blocks of words, so that a long text takes no more memory than a short one."""
        best = np.zeros((len(row) - 1, len(self.widths) * self.filters), np.float32)
        reach = max(self.widths) - 1
        for low in range(0, len(bucket), _BLOCK_WORDS):
            high = min(low + _BLOCK_WORDS, len(bucket))
            embedded = self.embed(bucket[low : high + reach])
            texts = np.arange(np.searchsorted(row, low, "right") - 1, np.searchsorted(row, high, "left"))
            for j, w in enumerate(self.widths):
                starts = np.maximum(row[texts], low) - low
                ends = np.minimum(row[texts + 1] - w + 1, high) - low
                some = ends > starts
                if not some.any():
                    continue
                value = self.convolved(embedded, w)
                cuts = np.stack([starts[some], ends[some]], 1).ravel()
                top = np.maximum.reduceat(value, cuts[:-1] if cuts[-1] == len(value) else cuts, axis=0)[::2] + self.bias[w]
                part = best[:, j * self.filters : (j + 1) * self.filters]
                part[texts[some]] = np.maximum(part[texts[some]], top)
        return best

    def raw(self, hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
        return (self.pooled(self.buckets(hashes), row) @ self.out + np.float32(self.offset)).astype(np.float64)

    def scores(self, hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Between 0 and 1; 0.5 is the calibrated threshold of the text's language."""
        raw = self.raw(hashes, row) - self.floor[self.languages(hashes[:, 0], row)]
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def train(texts: list[np.ndarray], labels: np.ndarray, epochs: int = 6, rate: float = 0.01, decay: float = 1e-4, languages: np.ndarray | None = None, **shape) -> Model:
    """``texts`` holds the word features of each text, of which the 16 leading bits are enough
    if ``languages`` (the number of each text's language) is given. Adam on logistic loss, both labels
    weighing the same, a third of the words' own buckets left out at random at each step; a
    fifth of the texts is kept back for the thresholds. With one label only (or no texts) every
    score is on that label's side of 0.5 (or 0.5)."""
    model = Model(**shape)
    if len(set(labels.tolist())) < 2:
        model.out[:] = 0
        model.offset = 0.0 if not len(labels) else (4.0 if labels[0] else -4.0)
        model.trained = len(labels) > 0
        return model
    r = np.random.default_rng(model.seed)
    order = r.permutation(len(texts))
    cut = max(1, len(texts) // 5)
    held, used = order[:cut], order[cut:]
    share = labels[used].mean()
    weight = np.where(labels == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
    weights = {"embedding": model.embedding, "out": model.out}
    weights |= {f"kernel{w}": model.kernel[w] for w in model.widths} | {f"bias{w}": model.bias[w] for w in model.widths}
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step, count = 0, model.filters
    for epoch in range(epochs):
        for chunk in np.array_split(r.permutation(used), max(1, len(used) // 32)):
            row = np.concatenate([[0], np.cumsum([len(texts[i]) for i in chunk])])
            if not row[-1]:
                continue
            step += 1
            bucket = model.buckets(np.concatenate([texts[i] for i in chunk]))
            shown = r.random(len(bucket)) > 1 / 3
            embedded = model.embed(bucket) - model.embedding[bucket[:, 0]] * ~shown[:, None]
            pooled = np.zeros((len(chunk), len(model.widths) * count), np.float32)
            where = np.full(pooled.shape, -1)
            for j, w in enumerate(model.widths):
                value = model.convolved(embedded, w)
                for t, (a, b) in enumerate(zip(row[:-1], row[1:] - w + 1)):
                    if b > a:
                        at = a + value[a:b].argmax(axis=0)
                        where[t, j * count : (j + 1) * count] = at
                        pooled[t, j * count : (j + 1) * count] = np.maximum(value[at, np.arange(count)] + model.bias[w], 0)
            score = 1 / (1 + np.exp(-np.clip(pooled @ model.out + model.offset, -30, 30)))
            error = ((score - labels[chunk]) * weight[chunk] / len(chunk)).astype(np.float32)
            pull = {k: np.zeros_like(v) for k, v in weights.items()}
            pull["out"] += pooled.T @ error
            back = error[:, None] * model.out * (pooled > 0)
            for j, w in enumerate(model.widths):
                part = back[:, j * count : (j + 1) * count]
                text, filt = np.nonzero(part)
                at, value = where[:, j * count : (j + 1) * count][text, filt], part[text, filt]
                np.add.at(pull[f"bias{w}"], filt, value)
                for k in range(w):
                    np.add.at(pull[f"kernel{w}"][k].T, filt, embedded[at + k] * value[:, None])
                    step_back = model.kernel[w][k][:, filt].T * value[:, None]
                    np.add.at(pull["embedding"], bucket[at + k, 0], step_back * shown[at + k, None])
                    for f in range(1, bucket.shape[1]):
                        np.add.at(pull["embedding"], bucket[at + k, f], step_back)
            for k, v in weights.items():
                first[k] += 0.1 * (pull[k] - first[k])
                second[k] += 0.01 * (pull[k] ** 2 - second[k])
                v -= rate * (first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8) + decay * v)
            model.offset -= rate * float(np.sign(error.sum()))
    _calibrate(model, [texts[i] for i in held], labels[held], None if languages is None else languages[held])
    return model


def _calibrate(model: Model, texts: list[np.ndarray], labels: np.ndarray, language: np.ndarray | None = None, least: int = 20) -> None:
    """For each language the threshold with the fewest errors on texts not trained on, in the
    middle of its gap; a language with too few of either label keeps that of all texts."""
    row = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    hashes = np.concatenate(texts)
    raw = model.raw(hashes, row)
    language = model.languages(hashes[:, 0], row) if language is None else language

    def best(mask: np.ndarray) -> float | None:
        value, label = raw[mask], labels[mask]
        if min((label == 1).sum(), (label == 0).sum()) < least:
            return None
        order = np.argsort(value, kind="stable")
        value, label = value[order], label[order]
        edges = np.concatenate([[value[0] - 1], (value[1:] + value[:-1]) / 2, [value[-1] + 1]])
        errors = np.concatenate([[0], np.cumsum(label == 1)]) + np.concatenate([[0], np.cumsum(label[::-1] == 0)])[::-1]
        low = np.flatnonzero(errors == errors.min())
        return float(edges[low[len(low) // 2]])

    common = best(np.ones(len(raw), bool)) or 0.0
    for k in range(len(LANGUAGES)):
        own = best(language == k)
        model.floor[k] = common if own is None else own


def fold_of(key: F.Column) -> F.Column:
    """crc32 of the key as text, modulo 5; fold 0 is held out."""
    return F.crc32(key.cast("string").cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", in_task: bool = False) -> Model:
    """Train on labelled texts outside fold 0. At most SAMPLE_ROWS of them (those with the
    smallest hash of the key, so the same at any layout) and SAMPLE_WORDS of their words are
    fetched, as the 16 leading bits of each word hash; nothing else reaches the driver. With
    ``in_task`` a task fetches them and trains, and the driver holds their sizes and the model alone. A text
    that does not fit what is left of SAMPLE_WORDS is passed over alone. Null
    texts, keys and labels teach nothing. Conflicting labels of a key: the larger counts; of
    several texts with one key, the one whose hashes sort first."""
    there = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("tf_key"))
    marks = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & (fold_of(F.col(key)) != 0))
        .groupBy(F.col(key).alias("tf_key")).agg(F.max(label).cast("int").alias("tf_label"))
        .join(there, "tf_key", "left_semi")  # labels of absent documents take no place in the sample
        .orderBy(F.xxhash64("tf_key"), "tf_key").limit(SAMPLE_ROWS)
    )
    marks = checkpointed(marks)
    chosen = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("tf_key"), F.col(text).alias("tf_text")).join(F.broadcast(marks), "tf_key")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model()
        for batch in batches:
            out, language = [], []
            for _, _, raw, at in pieces(batch.column("tf_text")):
                words = Words(raw, at, ALNUM)
                hashes = features(words)
                language += model.languages(hashes[:, 0], words.row).tolist()
                short = (hashes >> np.uint64(48)).astype(np.uint16)
                out += [short[a:b].tobytes() for a, b in zip(words.row[:-1], words.row[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("tf_key"), batch.column("tf_label"), pa.array(language, pa.int32()), pa.array(out, pa.binary())], names=["tf_key", "tf_label", "language", "words"])

    kind = T.StructType([chosen.schema["tf_key"], T.StructField("tf_label", T.IntegerType()), T.StructField("language", T.IntegerType()), T.StructField("words", T.BinaryType())])
    found = chosen.select("tf_key", "tf_label", "tf_text").mapInArrow(hashed, kind)
    found = checkpointed(found.groupBy("tf_key").agg(F.min(F.struct("words", "language", "tf_label")).alias("w")).select("tf_key", "w.*"))
    # At most SAMPLE_ROWS narrow rows decide on the driver which texts fit: one that does not is
    # passed over, and those after it are tried.
    width = 2 * (1 + len(PREFIXES))
    sizes = found.select("tf_key", F.octet_length("words").alias("n")).orderBy(F.xxhash64("tf_key"), "tf_key").collect()
    chosen, left = [], width * SAMPLE_WORDS
    for own, n in sizes:
        if n <= left:
            chosen.append((own,))
            left -= n
    fitting = docs.sparkSession.createDataFrame(chosen, T.StructType([found.schema["tf_key"]]))
    rows = found.join(F.broadcast(fitting), "tf_key")
    if not in_task:
        return _of_sample(rows.toArrow())
    made = rows.coalesce(1).mapInArrow(_in_task, "model binary").collect()
    return pickle.loads(made[0].model) if made else train([], np.zeros(0, np.int64))


def _of_sample(rows: pa.Table) -> Model:
    order = pc.sort_indices(rows.column("tf_key")).to_numpy()
    # Views of the fetched buffers, 16 bits a feature from here to the training steps.
    texts = [
        np.frombuffer(value.as_buffer(), np.uint16).reshape(-1, 1 + len(PREFIXES))
        for chunk in rows.column("words").chunks for value in chunk
    ]
    marks = rows.column("tf_label").to_numpy().astype(np.int64)
    return train([texts[i] for i in order], marks[order], languages=rows.column("language").to_numpy()[order])


def _in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [x for x in batches if x.num_rows]
    if rows:
        model = pickle.dumps(_of_sample(pa.Table.from_batches(rows)))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """The columns ``keep`` (default all), score (0 to 1) and predicted (1 from 0.5 on), their
    names led by ``prefix``, of every whole text.

    Null and empty texts score like a text without words. Each row stands for itself. One map,
    no shuffle; the model is about a megabyte, whatever the corpus. A kept column with the name
    of a new one is an error.
    """
    keep = docs.columns if keep is None else keep
    new = [prefix + "score", prefix + "predicted"]
    if clash := set(keep) & set(new):
        raise ValueError(f"columns {sorted(clash)} are there already: give a prefix")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = free_name("tf_text", keep)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(new[0], T.DoubleType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0)]
            for _, _, raw, at in pieces(batch.column(own)):
                words = Words(raw, at, ALNUM)
                found.append(shared.value.scores(features(words), words.row))
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), pa.array(np.concatenate(found))], names=names)

    scored = docs.select(*keep, F.col(text).alias(own)).mapInArrow(run, schema)
    return scored.withColumn(new[1], (F.col(new[0]) >= 0.5).cast("int"))
