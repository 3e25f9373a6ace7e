"""Scoring by a gated recurrent language model (operator 13).

Words are predicted from the state of a gated recurrent unit in two factors: the word's class, then the word
inside its class. Classes are blocks of the most frequent words; all rarer words are one last class, inside which
a word has its smoothed share of the corpus counts. Replicas learn in numpy by back-propagation through windows of some
words, each from its own partitions, and are averaged after each round. A text is scored whole: the state goes on
from window to window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rostrum.llm.common import fields, held_out, record_batch, table, text_slices
from rostrum.session import materialize

#: Word 0 is the end of a text. It also stands before a text's first word.
END = 0
COUNTS = fields("word binary, in_training long, in_all long")
REPLICA = fields("part int, weight double, params binary")
SCORED = T.StructType([
    *fields("key long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"),
    T.StructField("rest", T.ArrayType(T.BinaryType()))])


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The contract's words of whole texts, A-Z lower-cased and cut at the six ASCII spaces: all words (as bytes) and
    how many each text has. A null text has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    flat = lists.flatten()
    some = np.asarray(pc.binary_length(flat)) > 0  # spaces at either end leave empty strings
    before = np.concatenate([[0], np.cumsum(some)])
    offsets = np.asarray(lists.offsets) - (lists.offsets[0].as_py() if len(lists) else 0)
    sizes = np.diff(before[offsets]) if len(lists) else np.zeros(0, np.int64)
    return flat.filter(pa.array(some)).cast(pa.binary()), sizes


@dataclass
class Words:
    """The broadcast part of the vocabulary: the most frequent words of all texts, the end first.

    `model` is the model's word of each: 1 to `size` - 1 by their count in training, `size` for all others.
    """

    words: list[bytes]
    counts: np.ndarray
    model: np.ndarray
    size: int
    total: int
    distinct: int

    def find(self, flat: pa.Array, sizes: np.ndarray) -> np.ndarray:
        """The places of the words of texts, each closed by its end; -1 is a word that is not among the known."""
        if not hasattr(self, "_known"):
            self._known = pa.array(self.words, pa.binary())
        at = np.full(len(flat) + len(sizes), END, dtype=np.int32)
        ends = np.cumsum(sizes + 1) - 1
        inside = np.ones(len(at), dtype=bool)
        inside[ends] = False
        at[inside] = np.asarray(pc.fill_null(pc.index_in(flat, value_set=self._known), -1))
        return at

    def model_words(self, at: np.ndarray) -> np.ndarray:
        """The model's words of places; -1 is a word that is not among the known."""
        return np.where(at >= 0, self.model[at], np.int32(self.size))

    @property
    def tail(self) -> float:
        """What the counts + 1 inside the last class are divided by."""
        inside = self.model < self.size
        return float(self.total - self.counts[inside].sum() + self.distinct - (self.counts[inside] > 0).sum() + 1)


class Model:
    """The network: parameters as one flat vector, with views per name."""

    def __init__(self, size: int, width: int, hidden: int, flat: np.ndarray | None = None):
        self.size, self.width, self.hidden = size, width, hidden
        self.classes = -(-size // width)
        shapes = {"x": (size + 1, 3 * hidden), "u": (hidden, 3 * hidden), "c": (hidden, self.classes + 1), "cb": (self.classes + 1,),
                  "w": (self.classes, width, hidden), "wb": (self.classes, width)}
        total = sum(int(np.prod(s)) for s in shapes.values())
        self.flat = np.zeros(total, dtype=np.float32) if flat is None else flat.astype(np.float32)
        at = 0
        for name, shape in shapes.items():
            setattr(self, name, self.flat[at:at + int(np.prod(shape))].reshape(shape))
            at += int(np.prod(shape))

    def blank(self) -> Model:
        return Model(self.size, self.width, self.hidden)

    @classmethod
    def start(cls, words: Words, width: int, hidden: int) -> Model:
        """Biases give the corpus shares of classes and words: before any step the model is a unigram model."""
        new, rng = cls(words.size, width, hidden), np.random.default_rng(13)
        new.x[:] = rng.normal(0, 0.3, new.x.shape)
        new.u[:] = rng.normal(0, hidden ** -0.5, new.u.shape)
        share = np.zeros(new.classes * width)
        inside = words.model < words.size
        share[words.model[inside]] = words.counts[inside] + 1
        share = share.reshape(new.classes, width)
        with np.errstate(divide="ignore"):
            new.wb[:] = np.maximum(np.log(share), -80.0)  # places without a word
            new.cb[:-1] = np.log(share.sum(axis=1))
        new.cb[-1] = np.log(words.tail)
        return new

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """One word: (new state, reset gate, update gate, candidate, recurrent part of the candidate)."""
        k = self.hidden
        g = h @ self.u
        gates = x[:, :2 * k] + g[:, :2 * k]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1.0
        np.reciprocal(gates, out=gates)
        r, z, gn = gates[:, :k], gates[:, k:], g[:, 2 * k:]
        n = r * gn
        n += x[:, 2 * k:]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        return new, r, z, n, gn

    def outputs(self, h: np.ndarray, target: np.ndarray, grads: Model | None = None):
        """Log-probability (base e, without the counts of the last class) of each target; with `grads` also
        adds the gradients of the mean loss there and returns that of h."""
        m = len(h)
        rows, cls = np.arange(m), target // self.width
        cls = np.where(target >= self.size, self.classes, cls)
        # Classes x states: sums over classes then run along memory.
        columns = np.ascontiguousarray(h.T)
        logits = self.c.T @ columns + self.cb[:, None]
        logits -= logits.max(axis=0)
        logp = logits[cls, rows]
        e = np.exp(logits, out=logits)
        sums = e.sum(axis=0)
        logp -= np.log(sums)
        dh = None
        if grads is not None:
            e *= 1.0 / (m * sums)
            e[cls, rows] -= 1.0 / m
            grads.c += (e @ h).T
            grads.cb += e.sum(axis=1)
            dh = e.T @ self.c.T
        order = np.argsort(cls, kind="stable")
        cuts = np.searchsorted(cls[order], np.arange(self.classes + 1))
        for k in range(self.classes):
            some = order[cuts[k]:cuts[k + 1]]
            if not len(some):
                continue
            hs, word, at = h[some], target[some] - k * self.width, np.arange(len(some))
            inner = self.w[k] @ hs.T + self.wb[k][:, None]
            inner -= inner.max(axis=0)
            here = inner[word, at]
            e = np.exp(inner, out=inner)
            sums = e.sum(axis=0)
            logp[some] += here - np.log(sums)
            if grads is not None:
                e *= 1.0 / (m * sums)
                e[word, at] -= 1.0 / m
                grads.w[k] += e @ hs
                grads.wb[k] += e.sum(axis=1)
                dh[some] += e.T @ self.w[k]
        return logp, dh

    def window(self, source: np.ndarray, target: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray, Model]:
        """Loss, last state and gradients of a window (words x lanes); the state starts anew behind an end."""
        steps, lanes = source.shape
        k, x = self.hidden, self.x[source]
        goes = (source != END).astype(np.float32)[:, :, None]
        kept = []
        for t in range(steps):
            h_in = h * goes[t]
            h, r, z, n, gn = self.step(x[t], h_in)
            kept.append((h_in, r, z, n, gn, h))
        grads = self.blank()
        states = np.concatenate([s[5] for s in kept])
        logp, dstates = self.outputs(states, target.ravel(), grads)
        dstates = dstates.reshape(steps, lanes, k)
        dx, dg = np.empty((steps, lanes, 3 * k), np.float32), np.empty((steps, lanes, 3 * k), np.float32)
        back = np.zeros((lanes, k), np.float32)
        ut = np.ascontiguousarray(self.u.T)
        for t in range(steps - 1, -1, -1):
            h_in, r, z, n, gn, _ = kept[t]
            d = dstates[t] + back
            dan = d * (1 - z) * (1 - n * n)
            dx[t, :, :k] = dan * gn * r * (1 - r)
            dx[t, :, k:2 * k] = d * (h_in - n) * z * (1 - z)
            dx[t, :, 2 * k:] = dan
            dg[t, :, :2 * k] = dx[t, :, :2 * k]
            dg[t, :, 2 * k:] = dan * r
            back = (d * z + dg[t] @ ut) * goes[t]
        grads.u += np.concatenate([s[0] for s in kept]).T @ dg.reshape(-1, 3 * k)
        flat = source.ravel()
        order = np.argsort(flat, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) > 0]))
        grads.x[flat[order][starts]] = np.add.reduceat(dx.reshape(-1, 3 * k)[order], starts, axis=0)
        return -float(logp.mean()), h, grads


class Trainer:
    """Adam steps over a stream of words, in lanes of contiguous text."""

    def __init__(self, model: Model, rate: float, steps: int = 16, lanes: int = 512, lane_words: int = 1024):
        self.model, self.rate, self.steps, self.lanes, self.lane_words = model, rate, steps, lanes, lane_words
        self.first, self.second, self.buffer = (np.zeros_like(model.flat) for _ in range(3))
        self.updates = 0

    def update(self, grads: np.ndarray) -> None:
        norm = float(np.sqrt((grads * grads).sum()))
        if norm > 1.0:
            grads *= 1.0 / norm
        self.updates += 1
        buffer = self.buffer
        np.subtract(grads, self.first, out=buffer)
        buffer *= 0.1
        self.first += buffer
        np.multiply(grads, grads, out=grads)
        grads -= self.second
        grads *= 0.01
        self.second += grads
        np.sqrt(self.second, out=buffer)
        buffer += 1e-6
        np.divide(self.first, buffer, out=buffer)
        buffer *= self.rate * np.sqrt(1 - 0.99 ** self.updates) / (1 - 0.9 ** self.updates)
        self.model.flat -= buffer

    def learn(self, words: np.ndarray) -> float:
        """One pass over whole texts, each closed by an end. Returns the mean loss."""
        lanes = int(np.clip(2 * len(words) // self.lane_words, 16, self.lanes))
        length = -(-len(words) // lanes)
        source = np.concatenate([[END], words[:-1]])
        # The last lane is filled with ends, a text of no words.
        fill = lanes * length - len(words)
        target = np.concatenate([words, np.full(fill, END)]).reshape(lanes, length).T
        source = np.concatenate([source, np.full(fill, END)]).reshape(lanes, length).T
        h, losses = np.zeros((lanes, self.model.hidden), np.float32), []
        for at in range(0, length, self.steps):
            loss, h, grads = self.model.window(source[at:at + self.steps], target[at:at + self.steps], h)
            self.update(grads.flat)
            losses.append(loss)
        return float(np.mean(losses)) if losses else 0.0


def log_likelihoods(model: Model, texts: list[np.ndarray], block: int = 8192) -> np.ndarray:
    """The log-probability (base e, without the counts of the last class) of each whole text, its end included.

    Texts run side by side, longest first, so that a step takes all that still go on; outputs are worked out a
    block of states at a time. Memory follows the words of `texts`.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) for i in order], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(order) else np.zeros(0, dtype=np.int64)
    words = np.concatenate([texts[i] for i in order]) if order else np.zeros(0, dtype=np.int32)
    source = np.concatenate([[END], words[:-1]]) if len(words) else words
    source[starts] = END
    logp, h = np.zeros(len(words)), np.zeros((len(order), model.hidden), np.float32)
    held: list[np.ndarray] = []
    places: list[np.ndarray] = []
    waiting = 0

    def flush():
        nonlocal waiting
        at = np.concatenate(places)
        logp[at] = model.outputs(np.concatenate(held), words[at])[0]
        held.clear()
        places.clear()
        waiting = 0

    live = len(order)
    for t in range(int(sizes[0]) if len(order) else 0):
        while sizes[live - 1] <= t:
            live -= 1
        at = starts[:live] + t
        h = model.step(model.x[source[at]], h[:live])[0]
        held.append(h)
        places.append(at)
        waiting += live
        if waiting >= block:
            flush()
    if waiting:
        flush()
    out = np.zeros(len(texts))
    if len(order):
        out[np.array(order)] = np.add.reduceat(logp, starts)
    return out


def _merged(tables: list[pa.Table]) -> pa.Table:
    total = pa.concat_tables(tables).group_by("word").aggregate([("in_training", "sum"), ("in_all", "sum")])
    return total.select(["word", "in_training_sum", "in_all_sum"]).rename_columns(["word", "in_training", "in_all"])


def _count(most: int):
    """Words of a task's rows (text, learnt) with their counts, some hundred thousand different ones at a time."""
    def counted(words: pa.Array, learnt: bool) -> pa.Table:
        found = words.value_counts()
        n = found.field("counts").cast(pa.int64())
        return pa.table({"word": found.field("values"), "in_training": n if learnt else pa.array(np.zeros(len(n), np.int64)), "in_all": n})

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                flat, sizes = split_words(part.column(0))
                learnt = np.asarray(part.column(1).to_numpy(zero_copy_only=False), dtype=bool)
                mask = np.repeat(learnt, sizes)
                for words, texts, kind in ((flat.filter(pa.array(mask)), int(learnt.sum()), True), (flat.filter(pa.array(~mask)), int((~learnt).sum()), False)):
                    if texts:
                        held.append(counted(pa.concat_arrays([words, pa.array([b""], pa.binary())]), kind))
                        # The end, as often as there are texts.
                        ends = pa.table({"word": pa.array([b""], pa.binary()), "in_training": pa.array([(texts - 1) * kind]), "in_all": pa.array([texts - 1])})
                        held.append(ends)
                        size += len(held[-2])
                if size > most:
                    held = [_merged(held)]
                    size = len(held[0])
                    if size > most // 2:
                        yield from held[0].to_batches()
                        held, size = [], 0
        if held:
            yield from _merged(held).to_batches()

    return run


def word_counts(docs: DataFrame, most: int = 1_000_000) -> DataFrame:
    """(word, in_training, in_all) over `docs` (text, learnt); the empty word is the end of a text."""
    return docs.select("text", "learnt").mapInArrow(_count(most), COUNTS).groupBy("word").agg(
        F.sum("in_training").alias("in_training"), F.sum("in_all").alias("in_all"))


def vocabulary(counts: DataFrame, known: int, size: int) -> Words:
    """The `known` most frequent words of all texts, for the broadcast, and the model's `size` among them."""
    total, distinct = counts.agg(
        F.coalesce(F.sum("in_training"), F.lit(0)), F.coalesce(F.sum((F.col("in_training") > 0).cast("long")), F.lit(0))).first()
    end = counts.where(F.octet_length("word") == 0).select("in_training").first()
    top = counts.where(F.octet_length("word") > 0).orderBy(F.desc("in_all"), "word").limit(known - 1).select("word", "in_training").toArrow()
    words = [b"", *top.column(0).to_pylist()]
    found = np.array([end[0] if end else 0, *top.column(1).to_pylist()], dtype=np.int64)
    order = 1 + np.argsort(-found[1:], kind="stable")
    order = order[found[order] > 0][:size - 1]
    size = len(order) + 1
    model = np.full(len(words), size, dtype=np.int32)
    model[END] = END
    model[order] = np.arange(1, size)
    return Words(words, found, model, size, total, distinct)


def _train(words, flat: np.ndarray, width: int, hidden: int, rate: float, passes: int, parts: int):
    def run(batches):
        vocab = words.value
        trainer = Trainer(Model(vocab.size, width, hidden, flat.value), rate)
        buffer, held, seen = [], 0, 0

        def learn():
            text = vocab.model_words(np.concatenate(buffer))
            for _ in range(passes):
                trainer.learn(text)
            return len(text)

        for batch in batches:
            for part in text_slices(batch, "text"):
                buffer.append(vocab.find(*split_words(part.column(0))))
                held += len(buffer[-1])
                if held >= trainer.lanes * trainer.lane_words:
                    seen += learn()
                    buffer, held = [], 0
        if buffer:
            seen += learn()
        if seen:
            yield record_batch(REPLICA, {"part": [TaskContext.get().partitionId() % parts], "weight": [float(seen)],
                                         "params": [trainer.model.flat.tobytes()]})

    return run


def _average(frame):
    import pandas as pd

    total = frame["weight"].sum()
    mean = sum(np.frombuffer(p, np.float32).astype(np.float64) * (w / total) for p, w in zip(frame["params"], frame["weight"], strict=True))
    return pd.DataFrame({"part": [frame["part"].iloc[0]], "weight": [total], "params": [mean.astype(np.float32).tobytes()]})


def train(docs: DataFrame, words: Words, width: int = 48, hidden: int = 16, rounds: tuple[int, ...] = (1, 4, 16),
          rates: tuple[float, ...] = (0.01, 0.006, 0.003), least_words: int = 2_000_000, replicas: int = 64) -> Model:
    """The network learnt from all of `docs` (doc_id, text).

    Each round takes another part of the texts (sixteenths by a hash of id and text, up to the bounds in `rounds`), so
    that every text is learnt once; where there are fewer than `least_words` words each is repeated
    for as many passes as that takes. A round's tasks, at most `replicas`, start from the last average, stream
    their own texts and return one vector each; the vectors are averaged by words in two steps, so that a task
    reads about the root of their number and the driver no more.
    """
    spark = docs.sparkSession
    model = Model.start(words, width, hidden)
    shared = spark.sparkContext.broadcast(words)
    passes = max(1, -(-least_words // max(1, words.total)))
    parts = max(1, round(replicas ** 0.5))
    before = 0
    for bound, rate in zip(rounds, rates, strict=True):
        part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds[-1]))
        some = docs.where((part >= before) & (part < bound)).select("text").coalesce(replicas)
        flat = spark.sparkContext.broadcast(model.flat)
        learnt = some.mapInArrow(_train(shared, flat, width, hidden, rate, min(passes, 20), parts), REPLICA)
        rows = learnt.groupBy("part").applyInPandas(_average, REPLICA).collect()
        if rows:
            total = sum(r["weight"] for r in rows)
            mean = sum(np.frombuffer(r["params"], np.float32).astype(np.float64) * (r["weight"] / total) for r in rows)
            model = Model(words.size, width, hidden, mean)
        flat.unpersist()
        before = bound
    return model


def _score(words, flat, width: int, hidden: int, buffer_words: int):
    def run(batches):
        vocab = words.value
        model = Model(vocab.size, width, hidden, flat.value)
        log_counts, known = np.log10(vocab.counts + 1.0), vocab.counts > 0
        base, inner = np.log10(vocab.total + vocab.distinct + 1.0), np.log10(vocab.tail)
        key = TaskContext.get().partitionId() << 33

        def written(parts):
            """The rows of some slices: (ids, held out, words, words per text) each."""
            nonlocal key
            held, flat_words = pa.concat_arrays([p[1] for p in parts]), pa.concat_arrays([p[2] for p in parts])
            sizes = np.concatenate([p[3] for p in parts])
            at = vocab.find(flat_words, sizes)
            ends = np.cumsum(sizes + 1)
            starts = ends - sizes - 1
            ids = vocab.model_words(at)
            likely = log_likelihoods(model, np.split(ids, ends[:-1])) / np.log(10)
            found, outside = at >= 0, ids == vocab.size
            logs = np.where(found, log_counts[at], 0.0)

            def per_text(values):
                return np.add.reduceat(values, starts)

            rest = flat_words.filter(pa.array(np.delete(~found, ends - 1)))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_text((~found).astype(np.int64)))]), pa.int32()), rest)
            n = len(sizes)
            columns = {
                "key": key + np.arange(n), "doc_id": pa.concat_arrays([p[0] for p in parts]), "held_out": held, "n_tokens": sizes + 1,
                "n_known": per_text((found & known[at]).astype(np.int64)), "base": per_text(logs) - (sizes + 1) * base,
                "score": likely + per_text(np.where(outside, logs, 0.0)) - per_text(outside.astype(np.int64)) * inner, "rest": lists}
            key += n
            types = to_arrow_schema(SCORED)
            return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in types], schema=types)

        parts, waiting = [], 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                flat_words, sizes = split_words(part.column(1))
                parts.append((part.column(0), part.column(2), flat_words, sizes))
                waiting += len(flat_words) + len(sizes)
                if waiting >= buffer_words:
                    yield written(parts)
                    parts, waiting = [], 0
        if parts:
            yield written(parts)

    return run


def score_texts(docs: DataFrame, known_words: int = 1 << 18, model_words: int = 2304, width: int = 48, hidden: int = 16,
                buffer_words: int = 1 << 21) -> DataFrame:
    """Per row of `docs` (doc_id, text, held_out) its log10-probability under the network and under the base model.

    Counts cover every text, and every text that isn't held out is learnt. The `known_words` most frequent words are
    broadcast with their counts (a fixed bound, some megabytes); all others are joined by word
    with the whole table of counts. Each of them has fewer than a `known_words`-th of all words,
    held-out texts included, so no join key is hot. A task holds
    `buffer_words` words at a time; a longer text is scored whole, by itself.

    Null texts are empty: one token, the end. Rows with a null id are held out. Repeated rows are scored each. With no
    text to learn from all scores are those of the end alone. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "held_out")
    spark = docs.sparkSession
    counts = materialize(word_counts(docs.withColumn("learnt", ~F.col("held_out"))), "recurrent-counts")
    words = vocabulary(counts, known_words, model_words)
    model = train(docs.where(~F.col("held_out")), words, width, hidden)
    shared, flat = spark.sparkContext.broadcast(words), spark.sparkContext.broadcast(model.flat)
    scored = materialize(docs.mapInArrow(_score(shared, flat, width, hidden, buffer_words), SCORED), "recurrent-scores")
    rest = scored.select("key", F.explode("rest").alias("word"))
    found = rest.join(counts.where("in_training > 0").select("word", "in_training"), "word", "left")
    added = found.groupBy("key").agg(
        F.sum(F.log10(F.coalesce("in_training", F.lit(0)) + 1)).alias("_logs"), F.count("in_training").alias("_known"))
    logs = F.coalesce("_logs", F.lit(0.0))
    return scored.drop("rest").join(added, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"), (F.col("score") + logs).alias("score"))


def op13_recurrent_lm(spark, sf_dir: str) -> DataFrame:
    """All documents, scored by the network learnt from six sevenths of them."""
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs.withColumn("held_out", held_out(F.col("doc_id"), 7, 2)))
