"""Toxicity by two Kneser-Ney models, one per class, over words and over byte n-grams.

Each class has its own discounted counts of words and of five-byte grams. Both classes back off to the same
lower orders, built from all labelled texts by continuation counts: for a word, in how many texts it occurs; for
a gram, in how many contexts its shorter tails do. So an expression that is rare in both classes gives both the
same backed-off likelihood and does not speak for either. The two log-likelihoods are compared and normalised by
length, for the whole text and per word. A logistic curve, fitted on one fold that the calibration's counts
leave out, turns the text's, the highest and the three highest words' figures into a score.

The bytes' context starts anew at each word, so a word's figures depend on the word alone: grams are counted over
distinct words, and each distinct word of a pack of texts is scored once. Counts and statistics cover all labelled
texts outside the held-out fold. The model is a table of exact figures by gram, context and word (its 64-bit hash),
which grows with the corpus. Texts are packed, compressed and shuffled once into batches; the distinct expressions of
each batch are joined with the table, and each batch meets its own figures. What the model lacks takes the backoff
figure. Figures are whole multiples of 2**-24, so sums do not depend on their order.
A null or empty text is scored from zeros. Without labels of both kinds each score is the share of toxic ones
among them, or 0. Rows without an id are scored and never learned from; repeated rows give repeated rows;
an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tonearm.session import discard, staged

from .common import bit_table, fold_of, labels_of, likely_in, likely_known, texts_of

ORDER, DISCOUNT = 5, 0.75
#: Kinds of expressions: byte grams, words, contexts of grams.
GRAM, WORD, CONTEXT = 0, 1, 2
#: Bytes of text in a pack, and in a batch of packs whose expressions are looked up together.
PACK_BYTES, BATCH_BYTES = 8 << 20, 48 << 20
#: How hard a pack is compressed (zstd); it travels once and is kept until the scores are written.
LEVEL = 9
#: Words whose grams are unpacked at once.
WORDS = 1 << 16
#: Steps that deal packs evenly over the batches, by task and by place within it: golden ratio and square root of two.
DEAL = (0.6180339887498949, 0.4142135623730951)
#: Figures are whole multiples of one part in this.
UNIT = 1 << 24
#: The fold that calibrates, and the most documents of it that do.
CALIBRATION_FOLD, CALIBRATION_ROWS = 4, 8192
COUNTS = ("toxic", "plain", "toxic_fit", "plain_fit")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split()


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed five-byte grams of each word with four spaces before and one after; how many each word has."""
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    if not len(sizes):
        return np.zeros(0, np.int64), sizes
    lead = b" " * (ORDER - 1)
    data = np.frombuffer(b"".join([b"%b%b " % (lead, w) for w in words]), np.uint8).astype(np.int64)
    packed = data[: len(data) - ORDER + 1].copy()
    for i in range(1, ORDER):
        packed <<= 8
        packed |= data[i : i + len(packed)]
    own = np.arange(sizes.sum()) + np.repeat((ORDER - 1) * np.arange(len(sizes)), sizes)
    return packed[own], sizes


def names_of(words: list[bytes]) -> np.ndarray:
    """The hash that Spark's xxhash64 gives each word."""
    return np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64).view(np.int64)


def word_counts(train: DataFrame) -> DataFrame:
    """(word, toxic, plain, toxic_fit, plain_fit, texts) over (label, fold, text).

    ``texts`` says in how many texts a word is. The _fit counts leave the calibration fold out. Tasks add up
    what they read before anything is shuffled.
    """
    fields = train.sparkSession.createDataFrame([], "word binary, toxic long, plain long, toxic_fit long, plain_fit long, texts long").schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place: dict[bytes, int] = {}
            at, code, once = [], [], []
            for label, fold, text in zip(*(c.to_pylist() for c in batch.columns)):
                at.append(np.array([place.setdefault(w, len(place)) for w in words_of(text)], np.int64))
                code.append(2 * label + (fold != CALIBRATION_FOLD))
                once.append(np.unique(at[-1]))
            if not place:
                continue
            n = np.bincount(np.concatenate(at) * 4 + np.repeat(code, [len(a) for a in at]), minlength=4 * len(place)).reshape(-1, 4)
            seen = np.bincount(np.concatenate(once), minlength=len(place))
            parts = [n[:, 2] + n[:, 3], n[:, 0] + n[:, 1], n[:, 3], n[:, 1], seen]
            yield pa.RecordBatch.from_arrays([pa.array(list(place), pa.binary()), *map(pa.array, parts)], names=fields.names)

    return train.mapInArrow(count, fields).groupBy("word").agg(*(F.sum(c).alias(c) for c in (*COUNTS, "texts")))


def gram_counts(counted: DataFrame) -> DataFrame:
    """(gram, toxic, plain, toxic_fit, plain_fit) from the counts of words."""
    fields = counted.sparkSession.createDataFrame([], "gram long, toxic long, plain long, toxic_fit long, plain_fit long").schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                packed, sizes = grams(batch.column(0).to_pylist())
                order = np.argsort(packed, kind="stable")
                gram, first = np.unique(packed[order], return_index=True)
                sums = [np.add.reduceat(np.repeat(batch.column(i).to_numpy(), sizes)[order], first) for i in range(1, 5)]
                yield pa.RecordBatch.from_arrays([pa.array(gram), *map(pa.array, sums)], names=fields.names)

    return counted.select("word", *COUNTS).mapInArrow(count, fields).groupBy("gram").agg(*(F.sum(c).alias(c) for c in COUNTS))


def low(column: str, size: int):
    """The last ``size`` bytes of a packed gram."""
    return F.col(column).bitwiseAND(F.lit((1 << 8 * size) - 1))


def shared_backoff(counted: DataFrame) -> DataFrame:
    """(tail, p): the shared probability of each four-gram's last byte after its first three, by continuation counts.

    A context has at most 256 followers, so the windows over contexts stay small.
    """
    level = {ORDER: counted.select("gram")}
    for size in range(ORDER - 1, 0, -1):
        level[size] = level[size + 1].groupBy(low("gram", size).alias("gram")).agg(F.count("*").alias("n")).select("gram", "n")
        level[size + 1] = level[size + 1] if size + 1 == ORDER else staged(level[size + 1], "grams")
    p = None
    for size in range(1, ORDER):
        context = Window.partitionBy(F.shiftright("gram", 8))
        now = level[size].select("gram", "n", F.sum("n").over(context).alias("all"), F.count("*").over(context).alias("kinds"))
        shared = F.lit(1 / 256) if p is None else F.col("p")
        if p is not None:
            now = now.withColumn("tail", low("gram", size - 1)).join(p, "tail")
        p = now.select(F.col("gram").alias("tail"), ((F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("kinds") * shared) / F.col("all")).alias("p"))
        p = staged(p, "backoff")
    return p


def ratios(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, all, fit) and (context, all, fit): log-likelihood of the toxic model less the plain one's.

    The second holds for grams that neither class has: there the shared part cancels.
    """
    shared = shared_backoff(counted)
    grouped = counted.groupBy(F.shiftright("gram", 8).alias("context")).agg(*(f(c).alias(f"{c}_{k}") for c in COUNTS for f, k in ((F.sum, "n"), (lambda x: F.sum((F.col(x) > 0).cast("long")), "kinds"))))
    rest = {c: F.when(F.col(f"{c}_n") > 0, DISCOUNT * F.col(f"{c}_kinds") / F.col(f"{c}_n")).otherwise(1.0) for c in COUNTS}
    contexts = staged(grouped.select("context", *(F.col(f"{c}_n") for c in COUNTS), *(rest[c].alias(f"{c}_rest") for c in COUNTS)), "contexts")
    joined = counted.withColumn("context", F.shiftright("gram", 8)).withColumn("tail", low("gram", ORDER - 1)).join(contexts, "context").join(shared, "tail")
    seen = {c: F.when(F.col(f"{c}_n") > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.col(f"{c}_n")).otherwise(0.0) + F.col(f"{c}_rest") * F.col("p") for c in COUNTS}
    by_gram = joined.select("gram", (F.log(seen["toxic"]) - F.log(seen["plain"])).alias("all"), (F.log(seen["toxic_fit"]) - F.log(seen["plain_fit"])).alias("fit"))
    logs = {c: F.log(F.col(f"{c}_rest")) for c in COUNTS}
    by_context = contexts.select(F.col("context").alias("gram"), (logs["toxic"] - logs["plain"]).alias("all"), (logs["toxic_fit"] - logs["plain_fit"]).alias("fit"))
    return by_gram, by_context


def word_ratios(counted: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """(word, all, fit), and the figure of a word that no text has; one row of totals reaches the driver."""
    totals = counted.agg(F.sum("texts").alias("texts"), *(f(c).alias(f"{c}_{k}") for c in COUNTS for f, k in ((F.sum, "n"), (lambda x: F.sum((F.col(x) > 0).cast("long")), "kinds")))).first()
    rest = {c: DISCOUNT * totals[f"{c}_kinds"] / totals[f"{c}_n"] if totals[f"{c}_n"] else 1.0 for c in COUNTS}
    shared = F.col("texts") / F.lit(float(totals["texts"] or 1))
    p = {c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.lit(float(totals[f"{c}_n"] or 1)) + rest[c] * shared for c in COUNTS}
    rows = counted.select("word", (F.log(p["toxic"]) - F.log(p["plain"])).alias("all"), (F.log(p["toxic_fit"]) - F.log(p["plain_fit"])).alias("fit"))
    return rows, {"all": float(np.log(rest["toxic"] / rest["plain"])), "fit": float(np.log(rest["toxic_fit"] / rest["plain_fit"]))}


def model_table(by_gram: DataFrame, by_context: DataFrame, by_word: DataFrame, counts: str) -> DataFrame:
    """(kind, gram, figure): the figures by all counts or by the "fit" ones, in units."""
    named = by_word.withColumn("gram", F.xxhash64("word"))
    kinds = ((GRAM, by_gram), (CONTEXT, by_context), (WORD, named))
    figure = F.round(F.col(counts) * F.lit(float(UNIT))).cast("long").alias("figure")
    return reduce(DataFrame.unionByName, (rows.select(F.lit(kind).alias("kind"), "gram", figure) for kind, rows in kinds))


def packed(docs: DataFrame) -> DataFrame:
    """(batch, pack, rows): the rows (doc_id, fold, lower-cased words) in packs of some ``PACK_BYTES``, brought together by batch.

    A pack holds rows in the order read within a task; a longer text has a pack of its own.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, -(-size // BATCH_BYTES))
    rows = docs.select("doc_id", fold_of().alias("fold"), "text")
    schema = docs.sparkSession.createDataFrame([], "batch long, pack long, rows binary").schema

    def pack_of(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))) as out:
            out.write_table(pa.Table.from_batches(parts).combine_chunks())
        batch = int((number >> 32) * DEAL[0] % 1 * batches + (number & 0xFFFFFFFF) * DEAL[1] % 1 * batches) % batches
        return pa.RecordBatch.from_arrays([pa.array([batch]), pa.array([number]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=schema.names)

    def pack(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, read, now, held = TaskContext.get().partitionId() << 32, 0, 0, []
        for batch in batches_:
            if not batch.num_rows:
                continue
            ends = read + np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64))
            at, read = ends // PACK_BYTES, int(ends[-1])
            for a, b in pairwise([0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]):
                if at[a] != now and held:
                    yield pack_of(first + now, held)
                    held = []
                now = int(at[a])
                words = [b" ".join(words_of(t)) for t in batch.column(2).slice(a, b - a).to_pylist()]
                held.append(pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(words, pa.binary())], names=["doc_id", "fold", "words"]))
        if held:
            yield pack_of(first + now, held)

    return rows.mapInArrow(pack, schema).repartition(2 * batches, "batch").sortWithinPartitions("batch")


def unpacked(rows: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(rows.as_buffer()).read_all()


def expressions(packs: DataFrame) -> DataFrame:
    """(batch, kind, gram): the distinct expressions of each batch."""
    schema = packs.sparkSession.createDataFrame([], "batch long, kind int, gram long").schema

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((number, pack) for batch in batches for number, pack in zip(batch.column(0).to_pylist(), batch.column(2)))
        for number, own in groupby(rows, lambda r: r[0]):
            gram = name = np.zeros(0, np.int64)
            for _, pack in own:
                found: set[bytes] = set()
                for words in unpacked(pack).column("words"):
                    found.update(words.as_py().split())
                words = list(found)
                parts = [np.unique(grams(words[i : i + WORDS])[0]) for i in range(0, len(words), WORDS)]
                gram, name = np.unique(np.concatenate([gram, *parts])), np.union1d(name, names_of(words))
            for kind, asked in ((GRAM, gram), (CONTEXT, np.unique(gram >> 8)), (WORD, name)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(asked), number)), pa.array(np.full(len(asked), kind, np.int32)), pa.array(asked)], names=schema.names)

    return packs.mapInArrow(ask, schema)


class Figures:
    """Sorted expressions with their figures; the ones that are not there take ``missing``."""

    def __init__(self, gram: np.ndarray, values: np.ndarray, missing: float):
        order = np.argsort(gram, kind="stable")
        self.gram, self.values, self.missing = gram[order], values[order] / UNIT, missing

    def __call__(self, gram: np.ndarray) -> np.ndarray:
        if not len(self.gram):
            return np.full(len(gram), self.missing)
        at = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        return np.where(self.gram[at] == gram, self.values[at], self.missing)


def highest(words: np.ndarray) -> tuple[float, float]:
    top = np.partition(words, -3)[-3:] if len(words) > 3 else words
    return float(top.max()), float(top.mean())


def features(at: np.ndarray, n: np.ndarray, spelt: np.ndarray, named: np.ndarray) -> tuple[float, ...]:
    """By bytes and by words, of a text's words ``at``: the mean over the text, the highest word, the mean of the three highest."""
    if not len(at):
        return (0.0,) * 6
    n, spelt, named = n[at], spelt[at], named[at]
    return spelt.sum() / n.sum(), *highest(spelt / n), named.mean(), *highest(named)


def featured(docs: DataFrame, table: DataFrame, no_word: float) -> DataFrame:
    """(doc_id, fold, f0..f5) of (doc_id, text) by a table of (kind, gram, figure).

    A gram that neither class has takes its context's figure, and 0 where that is not there either.
    """
    packs = packed(docs)
    found = likely_in(expressions(packs), bit_table(table, "kind", "gram"), "kind", "gram").join(table, ["kind", "gram"]).select("batch", "kind", "gram", "figure")
    names = [f"f{i}" for i in range(6)]
    schema = "doc_id long, fold int, " + ", ".join(f"{n} double" for n in names)

    def score(packs: pa.Table, figures: pa.Table) -> pa.Table:
        kind, gram, value = (figures.column(c).to_numpy() for c in ("kind", "gram", "figure"))
        seen, unseen, known = (Figures(gram[kind == k], value[kind == k], m) for k, m in ((GRAM, np.nan), (CONTEXT, 0.0), (WORD, no_word)))
        ids, folds, made = [], [], []
        for pack in packs.column("rows"):
            rows = unpacked(pack)
            place: dict[bytes, int] = {}
            at = [np.array([place.setdefault(w, len(place)) for w in words.as_py().split()], np.int64) for words in rows.column("words")]
            words = list(place)
            spelt, n = np.zeros(len(words)), np.zeros(len(words), np.int64)
            for i in range(0, len(words), WORDS):
                gram, n[i : i + WORDS] = grams(words[i : i + WORDS])
                v = seen(gram)
                gap = np.flatnonzero(np.isnan(v))
                v[gap] = unseen(gram[gap] >> 8)
                own = n[i : i + WORDS]
                spelt[i : i + WORDS] = np.add.reduceat(v, np.cumsum(own) - own)
            named = known(names_of(words))
            ids += rows.column("doc_id").to_pylist()
            folds += rows.column("fold").to_pylist()
            made += [features(a, n, spelt, named) for a in at]
        columns = [pa.array(list(c), pa.float64()) for c in zip(*made)] or [pa.array([], pa.float64())] * len(names)
        return pa.table([pa.array(ids, pa.int64()), pa.array(folds, pa.int32()), *columns], names=["doc_id", "fold", *names])

    return packs.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(score, schema)


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton's method with a little ridge: (weights and bias, mean, scale)."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    ridge = np.diag([1.0] * (z.shape[1] - 1) + [1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
        w = w - np.clip(step, -4, 4)
    return w, mean, scale


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) per row, by models of the labelled rows outside the held-out fold."""
    known = labels_of(labels, label)
    train = likely_known(texts_of(docs, id_col, text_col), known).join(known, "doc_id").select(F.when(F.col("label") > 0, 1).otherwise(0).alias("label"), fold_of().alias("fold"), "text")
    counted = staged(word_counts(train), "counts")
    by_gram, by_context = ratios(staged(gram_counts(counted), "grams"))
    by_word, no_word = word_ratios(counted)
    models = {c: model_table(by_gram, by_context, by_word, c) for c in ("all", "fit")}
    table = {c: staged(model, "figures") for c, model in models.items()}
    discard(*models.values())  # the counts; the two tables are written
    texts = texts_of(docs, id_col, text_col)
    chosen = staged(known.where(fold_of() == CALIBRATION_FOLD).orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION_ROWS), "chosen")
    sample = featured(texts.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi"), table["fit"], no_word["fit"])
    sample = sample.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", *(f"f{i}" for i in range(6)))
    rows = sorted(map(tuple, sample.collect()))
    discard(table["fit"])
    y = np.array([min(r[1], 1) for r in rows], float)
    if len(y) and y.min() < y.max():
        w, mean, scale = logistic(np.array([r[2:] for r in rows], float), y)
    else:
        share = float(y.mean()) if len(y) else 0.0
        w, mean, scale = np.append(np.zeros(6), np.log(max(share, 1e-9) / max(1 - share, 1e-9))), np.zeros(6), np.ones(6)

    z = sum(((F.col(f"f{i}") - F.lit(float(mean[i]))) / F.lit(float(scale[i])) * F.lit(float(w[i])) for i in range(6)), F.lit(float(w[-1])))
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    scored = featured(texts, table["all"], no_word["all"])
    return scored.select("doc_id", (F.col("fold") == 0).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
