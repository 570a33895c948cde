"""Toxic texts by a convolutional classifier over hashed words.

Each word is the sum of two embeddings, of its hash and of its first letters'.
Filters of several widths run over the words, the largest answer of each counts, and a logistic
layer weighs them. All labelled texts are learnt from, in shards: each task goes on from the same model over its
shard's texts, and what the shards have changed is averaged, in rounds. A bounded sample only gives the model to start from. The threshold
is set for each language, from counts of all labelled texts that are held back from the rounds. Languages are learnt from the texts alone, as
groups that use the same frequent words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import BROADCAST_VALUES, WORD_BYTES, mapped, stored

@dataclass(frozen=True)
class Training:
    """All labelled texts are learnt from in ``rounds``, each task from about ``shard`` of them.

    The model they start from is learnt from at most ``rows``, half of them toxic, no text of over ``characters``, and of all together ``total``.
    """

    rows: int = 6000
    characters: int = 100_000
    total: int = 40_000_000
    buckets: int = 1 << 15
    size: int = 16
    filters: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    epochs: int = 6
    rate: float = 0.1
    batch: int = 32
    held_back: int = 4  # every so manieth id, by a hash, sets the thresholds instead
    rounds: int = 2
    shard: int = 10_000
    places: int = 256  # answers are counted for thresholds in steps of one over this
    frequent: int = 400  # words that tell languages apart
    groups: int = 16  # of texts to start from
    alike: float = 0.45  # cosine of two groups of one language
    share: float = 0.01  # of the texts that a language has at least
    seed: int = 7


@dataclass
class Languages:
    """How much each frequent word belongs to each language. A text is of the language its words belong to most, or of none."""

    words: dict[bytes, int] = field(default_factory=dict)
    centres: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))  # language x word

    def places(self, words: list[bytes]) -> list[int]:
        """Which of the frequent words a text has."""
        return sorted(self.words[word] for word in self.words.keys() & set(words))

    def of(self, words: list[bytes]) -> int:
        """The number of a text's language; one more than the last for a text of none."""
        return self.at(self.places(words))

    def at(self, places: list[int]) -> int:
        return int(self.centres[:, places].sum(1).argmax()) if places and self.centres.size else len(self.centres)


@dataclass
class Model:
    """A model without ``embedding`` answers ``base``; ``thresholds`` are those of each language, then of texts of none."""

    training: Training
    embedding: np.ndarray | None = None  # one more row than buckets, of zeros: no word
    filters: list[np.ndarray] | None = None  # by width: width x size x filters
    bias: list[np.ndarray] | None = None
    weights: np.ndarray | None = None
    offset: float = 0.0
    languages: Languages = field(default_factory=Languages)
    thresholds: tuple[float, ...] = (0.0,)
    base: float = 0.0


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


def learn_languages(texts: list[np.ndarray], words: list[bytes], training: Training, frequent: list[bytes] | None = None) -> Languages:
    """Groups of texts that have the same frequent words, those of the texts if none are given; texts are numbers of ``words``.

    Texts far from each other are what groups start from; each text then goes to the closest group and each group to the mean of its
    texts, in turns. Groups that are alike become one, and small ones go to others. All is told by the texts, in their order.
    """
    distinct = [np.unique(text) for text in texts]
    if frequent is None:
        counts = np.bincount(np.concatenate([*distinct, np.empty(0, np.int64)]), minlength=len(words))
        codes = sorted(np.flatnonzero(counts > 1).tolist(), key=lambda code: (-counts[code], words[code]))[: training.frequent]
        frequent = [words[code] for code in codes]
    known = {word: place for place, word in enumerate(frequent)}
    places = np.array([known.get(word, -1) for word in words], np.int64)
    has = np.zeros((len(texts), len(known)), np.float32)
    for i, codes in enumerate(distinct):
        has[i, places[codes][places[codes] >= 0]] = 1
    enough = has.sum(1) >= 8
    if not enough.any():
        return Languages()
    has = has[enough]
    unit = has / np.sqrt(has.sum(1))[:, None]

    def means(group: np.ndarray) -> np.ndarray:
        sums = np.array([unit[group == k].sum(0) for k in range(group.max() + 1)])
        sums = sums[sums.any(1)]
        return sums / np.linalg.norm(sums, axis=1)[:, None]

    def settled(centres: np.ndarray) -> np.ndarray:
        group = (unit @ centres.T).argmax(1)
        for _ in range(10):
            centres = means(group)
            group = (unit @ centres.T).argmax(1)
        return group

    centres = unit[[int(has.sum(1).argmax())]]
    closest = unit @ centres[0]
    while len(centres) < training.groups and closest.min() < training.alike:
        centres = np.append(centres, unit[[int(closest.argmin())]], 0)
        closest = np.maximum(closest, unit @ centres[-1])
    group = settled(centres)
    while True:
        group = np.unique(group, return_inverse=True)[1]
        near = means(group) @ means(group).T
        cosine, a, b = max(((near[a, b], a, b) for a, b in combinations(range(len(near)), 2)), default=(0.0, 0, 0))
        if cosine < training.alike:
            break
        group[group == b] = a
    sizes = np.bincount(group)
    large = sizes >= min(training.share * len(unit), sizes.max())
    return Languages(known, means(settled(means(group)[large])))


def bucket_pair(word: bytes, buckets: int) -> tuple[int, int]:
    return xxhash.xxh32_intdigest(word) % buckets, xxhash.xxh32_intdigest(b"^" + word[:6]) % buckets


def _laid_out(docs: list[np.ndarray], gap: int, nothing: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' rows one after the other with ``gap`` empty places between, where each starts, and which places are texts."""
    sizes = np.array([len(doc) for doc in docs])
    starts = np.concatenate([[0], np.cumsum(sizes + gap)[:-1]])
    out = np.full((int(sizes.sum() + gap * len(docs)), *docs[0].shape[1:]), nothing)
    inside = np.zeros(len(out), bool)
    for start, doc in zip(starts.tolist(), docs, strict=True):
        out[start : start + len(doc)] = doc
        inside[start : start + len(doc)] = True
    return out, starts, inside


def fresh(training: Training) -> Model:
    """A model that has learnt nothing yet."""
    rng = np.random.default_rng(training.seed)
    size, filters = training.size, training.filters
    model = Model(training)
    model.embedding = np.zeros((training.buckets + 1, size), np.float32)
    model.embedding[:-1] = rng.normal(0, 0.05, (training.buckets, size))
    model.filters = [rng.normal(0, 1 / np.sqrt(width * size), (width, size, filters)).astype(np.float32) for width in training.widths]
    model.bias = [np.zeros(filters, np.float32) for _ in training.widths]
    model.weights = rng.normal(0, 0.3, filters * len(training.widths)).astype(np.float32)
    return model


class Learner:
    """Steps of descent on a model, in place; ``squares`` are the sums of the squared slopes so far."""

    def __init__(self, model: Model, squares: list[np.ndarray] | None = None):
        self.model = model
        self.learnt = [model.embedding, *model.filters, *model.bias, model.weights]
        self.squares = squares or [np.full(a.shape, 1e-6, np.float32) for a in self.learnt]

    def _step(self, which: int, gradient: np.ndarray) -> None:
        self.squares[which] += gradient**2
        self.learnt[which] -= self.model.training.rate * gradient / np.sqrt(self.squares[which])

    def learn(self, docs: list[np.ndarray], y: np.ndarray, balance: np.ndarray) -> np.ndarray:
        """One step for texts, given as pairs of buckets; ``balance`` is how much each counts. Returns the rows of the embedding it changed."""
        model, training = self.model, self.model.training
        size, filters, gap = training.size, training.filters, max(training.widths)
        rows, starts, inside = _laid_out(docs, gap, training.buckets)
        x = model.embedding[rows[:, 0]] + model.embedding[rows[:, 1]]
        padded = np.concatenate([x, np.zeros((gap, size), np.float32)])
        pooled, at = [], []
        for width, w, b in zip(training.widths, model.filters, model.bias, strict=True):
            z = sum(padded[j : j + len(x)] @ w[j] for j in range(width)) + b
            z[~inside] = -np.inf
            ends = np.append(starts[1:], len(x))
            at.append(np.stack([start + z[start:end].argmax(0) for start, end in zip(starts, ends, strict=True)]))
            pooled.append(np.take_along_axis(z, at[-1], 0))
        answers = np.maximum(np.concatenate(pooled, 1), 0)
        p = 1 / (1 + np.exp(-np.clip(answers @ model.weights + model.offset, -30, 30)))
        wrong = (p - y) * balance / len(docs)
        back = wrong[:, None] * model.weights * (answers > 0)
        model.offset -= 0.5 * float(wrong.sum())
        self._step(len(self.learnt) - 1, answers.T @ wrong)
        touched, given = [], []
        for k, width in enumerate(training.widths):
            g = back[:, k * filters : (k + 1) * filters]
            slope = np.empty_like(model.filters[k])
            for j in range(width):
                seen = padded[at[k] + j]  # texts x filters x size
                slope[j] = np.einsum("df,dfs->sf", g, seen)
                place = np.minimum(at[k] + j, len(rows) - 1)
                for side in (0, 1):
                    touched.append(rows[place, side].ravel())
                    given.append((g[:, :, None] * model.filters[k][j].T[None]).reshape(-1, size))
            self._step(1 + k, slope)
            self._step(1 + len(training.widths) + k, g.sum(0))
        touched, given = np.concatenate(touched), np.concatenate(given)
        distinct, back_to = np.unique(touched, return_inverse=True)
        sums = np.zeros((len(distinct), size), np.float32)
        np.add.at(sums, back_to, given)
        sums[distinct == training.buckets] = 0
        self.squares[0][distinct] += sums**2
        model.embedding[distinct] -= training.rate * sums / np.sqrt(self.squares[0][distinct])
        return distinct[sums.any(1)]


def balanced(y: np.ndarray, toxic: float) -> np.ndarray:
    """How much rows count, so that both kinds do alike, if this share of the rows is toxic."""
    return np.where(y == 1, 0.5 / toxic, 0.5 / (1 - toxic)).astype(np.float32)


def train(texts: list[str], labels: list[int], own: np.ndarray, frequent: list[bytes], training: Training) -> tuple[Model, list[np.ndarray]] | None:
    """A model of a few labelled texts to start from, and its squared slopes; None without both kinds.

    Only rows in ``own`` are learnt from; languages are those of all the texts.
    """
    known: dict[bytes, int] = {}
    pairs: list[tuple[int, int]] = []
    docs = []
    for text in texts:
        words = words_of(text)
        for word in words:
            if word not in known:
                known[word] = len(pairs)
                pairs.append(bucket_pair(word, training.buckets))
        docs.append(np.array([known[word] for word in words], np.int64))
    y = np.array(labels, np.float32)
    if len(set(y[own])) < 2:
        return None
    table = np.array(pairs, np.int64).reshape(-1, 2)
    model = fresh(training)
    model.languages = learn_languages(docs, list(known), training, frequent)
    learner, rng, chosen_from = Learner(model), np.random.default_rng(training.seed), np.flatnonzero(own)
    balance = balanced(y, y[own].mean())
    for _ in range(training.epochs):
        for chosen in np.array_split(rng.permutation(chosen_from), max(1, len(chosen_from) // training.batch)):
            learner.learn([table[docs[i]] for i in chosen], y[chosen], balance[chosen])
    return model, learner.squares


def thresholds(answers: np.ndarray, y: np.ndarray, weights: np.ndarray, spoken: np.ndarray, languages: int) -> tuple[float, ...]:
    """The answer from which on a text of each language counts as toxic: where precision and recall are best together.

    ``weights`` are the numbers of texts with an answer. A language with under 10 texts of either kind takes the threshold of all.
    """

    def best(chosen: np.ndarray) -> float:
        order = np.argsort(-answers[chosen], kind="stable")
        a, positive, weight = answers[chosen][order], y[chosen][order] == 1, weights[chosen][order]
        hits = np.cumsum(weight * positive)
        f1 = 2 * hits / (np.cumsum(weight) + (weight * positive).sum())
        f1[:-1][a[:-1] == a[1:]] = -1  # equal answers are on one side
        k = int(f1.argmax())
        return float((a[k] + (a[k + 1] if k + 1 < len(a) else a[k] - 1)) / 2)

    every = best(np.ones(len(y), bool))
    out = []
    for number in range(languages):
        own = spoken == number
        enough = min(weights[own & (y == 1)].sum(), weights[own & (y == 0)].sum()) >= 10
        out.append(best(own) if enough else every)
    return tuple(out)


def logits(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The classifier's answer to each text, and the language it is in."""
    training = model.training
    known: dict[bytes, int] = {}
    docs, spoken = [], []
    for text in texts:
        words = words_of(text)
        spoken.append(model.languages.of(words))
        docs.append(np.fromiter((known.setdefault(word, len(known)) for word in words), np.int32, len(words)))
    pairs = np.array([bucket_pair(word, training.buckets) for word in known], np.int64).reshape(-1, 2)
    return _answers(model, pairs, docs), np.array(spoken)


def _answers(model: Model, pairs: np.ndarray, docs: list[np.ndarray]) -> np.ndarray:
    """The classifier's answers to texts that are numbers of distinct ``pairs`` of buckets."""
    training = model.training
    nothing, gap = len(pairs), max(training.widths)
    pairs = np.append(pairs, [[training.buckets] * 2], 0)
    x = model.embedding[pairs[:, 0]] + model.embedding[pairs[:, 1]]
    places, starts, inside = _laid_out(docs, gap, nothing)
    padded = np.append(places, np.full(gap, nothing))
    pooled = []
    for width, w, b in zip(training.widths, model.filters, model.bias, strict=True):
        # A filter's answer to a window is the sum of its answers to the words, which distinct words share.
        z = (x @ w[0])[places]
        for j in range(1, width):
            z += (x @ w[j])[padded[j : j + len(places)]]
        z += b
        z[~inside] = 0
        pooled.append(np.maximum(np.maximum.reduceat(z, starts), 0))
    return np.concatenate(pooled, 1) @ model.weights + model.offset


TOGETHER = 1_000_000  # characters of texts scored at a time


def score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """doc_id, held_out, text -> doc_id, held_out, score."""

    def scored(texts: list[str]) -> np.ndarray:
        if model.embedding is None:
            return np.full(len(texts), model.base)
        answers, languages = logits(model, texts)
        return 1 / (1 + np.exp(-np.clip(answers - np.array(model.thresholds)[languages], -500, 500)))

    for batch in batches:
        out, texts, size = [], [], 0
        for scalar in batch.column(2):
            texts.append(scalar.as_py() or "")
            size += len(texts[-1])
            if size >= TOGETHER:
                out.append(scored(texts))
                texts, size = [], 0
        if texts:
            out.append(scored(texts))
        scores = pa.array(np.concatenate(out) if out else np.empty(0))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores], names=["doc_id", "held_out", "score"])


def held_out(id_column: Column) -> Column:
    """Whether a row's label is not learnt from; rows without an id are held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> word, n: in how many texts a word is, in parts that are to be added up."""
    counts: Counter[bytes] = Counter()

    def flushed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for scalar in batch.column(0):
            counts.update(set(words_of(scalar.as_py())))
            if len(counts) > 200_000:
                yield flushed()
    yield flushed()


def frequent_words(rows: DataFrame, training: Training) -> list[bytes]:
    """The words that most of the texts have, of those in two at least."""
    counted = mapped(rows.select("text"), count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.where("n > 1").orderBy(F.desc("n"), "word").limit(training.frequent).collect()
    return [bytes(row["word"]) for row in top]


def _code_type(buckets: int) -> str:
    return "<u4" if (buckets + 1) ** 2 <= 1 << 32 else "<u8"


def encode(batches: Iterator[pa.RecordBatch], frequent: list[bytes], buckets: int) -> Iterator[pa.RecordBatch]:
    """id, key, y, back, text -> id, key, y, back, codes, places: a number for each word's pair of buckets, and the frequent words it has.

    Of a batch's rows with one id that of the smallest key goes on, so that an id of very many rows makes few.
    """
    kind, languages = _code_type(buckets), Languages({word: place for place, word in enumerate(frequent)})
    numbers: dict[bytes, int] = {}
    for batch in batches:
        least: dict[int, tuple[int, int]] = {}
        for i, (number, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            least[number] = min(least.get(number, (key, i)), (key, i))
        if len(least) < batch.num_rows:
            batch = batch.take(pa.array(sorted(i for _, i in least.values())))
        codes, places = [], []
        for scalar in batch.column(4):
            words = words_of(scalar.as_py())
            if len(numbers) > 500_000:
                numbers.clear()
            for word in words:
                if word not in numbers:
                    first, second = bucket_pair(word, buckets)
                    numbers[word] = first * (buckets + 1) + second
            codes.append(np.fromiter((numbers[word] for word in words), kind, len(words)).tobytes())
            places.append(np.array(languages.places(words), "<u2").tobytes())
        arrays = [*batch.columns[:4], pa.array(codes, pa.binary()), pa.array(places, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["id", "key", "y", "back", "codes", "places"])


BLOCK = 1024  # rows of an embedding that are sent together
DENSE, SPOKEN = -1, -2  # the blocks of the other numbers learnt, and of the languages
WORDS_TOGETHER = 200_000


def _encoded(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[tuple[int, int, bool, np.ndarray, list[int]]]:
    """The rows of a shard, in which those of an id follow each other: the first of each id."""
    kind, last = _code_type(buckets), None
    for batch in batches:
        for scalar, _, y, back, codes, places in zip(*batch.columns, strict=True):
            number = scalar.as_py()
            if number == last:
                continue
            last, numbers = number, np.frombuffer(codes.as_py(), kind).astype(np.int64)
            yield number, y.as_py(), back.as_py(), numbers, np.frombuffer(places.as_py(), "<u2").tolist()


def _dense(model: Model) -> np.ndarray:
    return np.concatenate([a.ravel() for a in (*model.filters, *model.bias, model.weights)] + [[model.offset]]).astype(np.float64)


def learn_shard(batches: Iterator[pa.RecordBatch], model: Model, squares: list[np.ndarray], toxic: float, apart: bool) -> Iterator[pa.RecordBatch]:
    """A shard's rows -> block, first, values: what learning from them changes, and sums of the texts of each language.

    ``toxic`` is the share of such rows; with ``apart`` rows that are held back are not learnt from. ``first`` tells shards apart.
    """
    training, before, dense = model.training, model.embedding.copy(), _dense(model)
    learner = Learner(model, squares)
    touched = np.zeros(training.buckets + 1, np.float64)
    sums = np.zeros(model.languages.centres.shape, np.float64)
    docs, labels, words, n, first = [], [], 0, 0, None

    def learn() -> None:
        y = np.array(labels, np.float32)
        touched[learner.learn(docs, y, balanced(y, toxic))] = 1
        docs.clear()
        labels.clear()

    for number, y, back, codes, places in _encoded(batches, training.buckets):
        first = number if first is None else first
        if len(places) >= 8 and len(sums):
            sums[model.languages.at(places), places] += 1 / np.sqrt(len(places))
        if back and apart:
            continue
        docs.append(np.stack(np.divmod(codes, training.buckets + 1), 1))
        labels.append(y)
        words, n = words + len(codes), n + 1
        if len(docs) == training.batch or words >= WORDS_TOGETHER:
            learn()
            words = 0
    if docs:
        learn()
    if first is None:
        return
    changed = model.embedding - before
    blocks = [(DENSE, np.append((_dense(model) - dense) * n, n)), (SPOKEN, sums.ravel())]
    for k in range(0, training.buckets, BLOCK):
        part = slice(k, min(k + BLOCK, training.buckets))
        blocks.append((k, np.append(changed[part].ravel(), touched[part])))
    numbers = [pa.array([k for k, _ in blocks], pa.int32()), pa.array([first] * len(blocks), pa.int64())]
    values = pa.array([v.astype("<f4" if k >= 0 else "<f8").tobytes() for k, v in blocks], pa.binary())
    yield pa.RecordBatch.from_arrays([*numbers, values], names=["block", "first", "values"])


def add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block, first, values -> block, values: the sums, as doubles, in the order of the rows."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, values in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            own = np.frombuffer(values.as_py(), "<f4" if block >= 0 else "<f8")
            sums[block] = sums[block] + own if block in sums else own.astype(np.float64)
    values = pa.array([v.tobytes() for v in sums.values()], pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), values], names=["block", "values"])


def learn_round(rows: DataFrame, model: Model, squares: list[np.ndarray], toxic: float, apart: bool) -> Model:
    """The model after all shards have gone on from it, and their changes are averaged.

    A row of the embedding changes by the mean of the shards that have its words; languages become the means of their texts.
    """
    training = model.training
    parts = mapped(rows, learn_shard, "block int, first long, values binary", model, squares, toxic, apart)
    parts = parts.repartition("block").sortWithinPartitions("block", "first")
    sums = {row["block"]: np.frombuffer(row["values"]) for row in mapped(parts, add_blocks, "block int, values binary").collect()}
    embedding = model.embedding.copy()
    for k in range(0, training.buckets, BLOCK):
        own = embedding[k : min(k + BLOCK, training.buckets)]
        changed, touched = np.split(sums[k], [own.size])
        own += changed.reshape(own.shape) / np.maximum(touched, 1)[:, None]
    dense, places = _dense(model) + sums[DENSE][:-1] / max(sums[DENSE][-1], 1), 0
    learnt = []
    for a in (*model.filters, *model.bias, model.weights):
        learnt.append(dense[places : places + a.size].reshape(a.shape).astype(np.float32))
        places += a.size
    widths, languages = len(training.widths), model.languages
    if languages.centres.size:
        spoken = sums[SPOKEN].reshape(languages.centres.shape)
        norms = np.linalg.norm(spoken, axis=1)[:, None]
        centres = np.where(norms > 0, spoken / np.where(norms > 0, norms, 1), languages.centres).astype(np.float32)
        languages = Languages(languages.words, centres)
    return replace(
        model, embedding=embedding, filters=learnt[:widths], bias=learnt[widths:-1], weights=learnt[-1], offset=float(dense[-1]), languages=languages
    )


def judge_shard(batches: Iterator[pa.RecordBatch], model: Model, apart: bool) -> Iterator[pa.RecordBatch]:
    """A shard's rows that are held back -> language, answer, y, n: how many have an answer, in steps; with ``apart`` False all rows."""
    training = model.training
    counts: Counter[tuple[int, int, int]] = Counter()
    docs, labels, spoken, words = [], [], [], 0

    def judge() -> None:
        sizes = np.cumsum([len(codes) for codes in docs])[:-1]
        codes, numbers = np.unique(np.concatenate(docs), return_inverse=True)
        answers = _answers(model, np.stack(np.divmod(codes, training.buckets + 1), 1), np.split(numbers, sizes))
        counts.update(zip(spoken, np.floor(answers * training.places).astype(np.int64).tolist(), labels, strict=True))
        for kept in (docs, labels, spoken):
            kept.clear()

    for _, y, back, codes, places in _encoded(batches, training.buckets):
        if back or not apart:
            docs.append(codes)
            labels.append(y)
            spoken.append(model.languages.at(places))
            words += len(codes)
        if words >= WORDS_TOGETHER:
            judge()
            words = 0
    if docs:
        judge()
    columns = [pa.array([key[i] for key in counts], kind) for i, kind in enumerate((pa.int32(), pa.int64(), pa.int32()))]
    yield pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64())], names=["language", "answer", "y", "n"])


def learn_thresholds(rows: DataFrame, model: Model, apart: bool) -> tuple[float, ...]:
    """Thresholds by the answers to all rows held back, counted in steps of ``1 / places``."""
    counted = mapped(rows, judge_shard, "language int, answer long, y int, n long", model, apart)
    counted = counted.groupBy("language", "answer", "y").agg(F.sum("n").alias("n")).orderBy("language", "answer", "y").collect()
    spoken, answers, y, n = (np.array([row[name] for row in counted]) for name in ("language", "answer", "y", "n"))
    return thresholds((answers + 0.5) / model.training.places, y, n.astype(np.float64), spoken, len(model.languages.centres) + 1)


def fit(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> Model:
    """Train on all labelled rows that are not held out.

    An id with several labels is toxic if one says so; null labels are left out, as are null texts. Of several texts
    of an id, that of the smallest hash is learnt from. One in ``training.held_back`` ids, by a hash, sets the thresholds instead; if there is only one
    kind of label among these or among the others, all rows do both. The model depends on the rows only, not on how they lie in files.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
    known = stored(known.agg(F.max("toxic").cast("int").alias("y")).where(~held_out(F.col("id"))), "labels")
    n = known.count()
    text, back = F.col("text"), (F.pmod(F.xxhash64("id"), F.lit(training.held_back)) == 0).alias("back")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text).where(text.isNotNull() & ~held_out(F.col("id")))
    rows = rows.join(F.broadcast(known) if n <= BROADCAST_VALUES else known, "id")
    frequent = frequent_words(rows, training)
    found = train(*_sample(docs, known, training), frequent, training)

    encoded = mapped(rows.select("id", F.xxhash64("text").alias("key"), "y", back, "text"), encode, _ENCODED, frequent, training.buckets)
    encoded = encoded.repartition(-(-n // training.shard) or 1, "id").sortWithinPartitions(F.xxhash64("id"), "id", "key")
    encoded.persist(StorageLevel.DISK_ONLY)
    try:
        counted = encoded.select("id", "back", "y").distinct().groupBy("back", "y").count().collect()
        counts = Counter({(row["back"], row["y"]): row["count"] for row in counted})
        toxic = counts[False, 1] + counts[True, 1]
        if not toxic or toxic == counts.total():
            return Model(training, base=float(toxic > 0))
        apart = all(counts[of] for of in ((False, 0), (False, 1), (True, 0), (True, 1)))
        share = counts[False, 1] / (counts[False, 0] + counts[False, 1]) if apart else toxic / counts.total()
        model, squares = found or (fresh(training), None)
        for _ in range(training.rounds):
            model = learn_round(encoded, model, squares, share, apart)
        return replace(model, thresholds=learn_thresholds(encoded, model, apart))
    finally:
        encoded.unpersist()


_ENCODED = "id long, key long, y int, back boolean, codes binary, places binary"


def _sample(docs: DataFrame, known: DataFrame, training: Training) -> tuple[list[str], list[int], np.ndarray]:
    """Texts to start from, their labels and whether they are learnt from: chosen by a hash of their id, toxic and other ones alike."""
    halves = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(training.rows // 2) for y in (0, 1)]
    chosen = F.broadcast(halves[0].union(halves[1]))
    text = F.col("text")
    short = text.isNotNull() & (F.length(text) <= training.characters)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text).where(short).join(chosen, "id")
    rows = stored(rows.groupBy("id", "y").agg(F.min("text").alias("text")), "sample")
    # Ids and lengths first, a few bytes a row: as many texts, in the order of a hash, as there is room for.
    sizes = rows.select("id", F.length("text").alias("size")).collect()
    sizes.sort(key=lambda row: xxhash.xxh64_intdigest(str(row["id"])))
    room, taken = training.total, []
    for row in sizes:
        room -= row["size"]
        if room < 0:
            break
        taken.append((row["id"],))
    taken = docs.sparkSession.createDataFrame(taken, "id long")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.lit(training.held_back)) != 0)
    rows = rows.join(F.broadcast(taken), "id", "left_semi").collect()
    rows = sorted(rows, key=lambda row: xxhash.xxh64_intdigest(str(row["id"])))
    return [row["text"] for row in rows], [row["y"] for row in rows], np.array([row["own"] for row in rows], bool)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    The score is the probability, moved so that 0.5 is the threshold of the text's
    language. Only the text is read for it; null and empty texts are scored as texts without words. A null id
    stays null; repeated rows are each scored.
    """
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "text")
    scored = mapped(rows, score_batches, "doc_id long, held_out boolean, score double", model)
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
