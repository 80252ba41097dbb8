"""Language-model scores: a log-bilinear model over classes of the whole vocabulary, trained with noise-contrastive estimation.

A word's probability is that of its class after the class before it and the kind of the word before that, times the word's share of its class. Both levels are
normalised, so the whole adds up to one over all words of the training rows and one more for any unknown word.

Classes. The commonest words have a class of their own. Every other word seen at least twice gets a vector: the sum of fixed random codes
of the common words that stand before and after it, over all its occurrences in the training rows. Vectors are cut
into classes by their nearest centre; the centres are fitted on the vectors of a bounded number of common words. A few coarse centres give
every class its kind in the same way. Words seen once share the class of
the unknown ones: how often something new comes, and after what, is learned from them; the unknown word's share in it
follows from how many words were seen once and twice.

Class model. The context's vector is a sum of one matrix product per place, the score its product with the class's output vector plus a bias.
Training reads the counts of all class trigrams of the training rows, every occurrence in every round. They are dealt out to parts of bounded size, as many as the
corpus needs; in each round every part runs its own steps from the same parameters, and the driver averages them. Probabilities are
normalised: the sum over all classes is taken once for every possible context, by batched matrix products.

The corpus is kept in chunks. Counts and vectors are summed up per chunk, settled by ranges of word hashes and sent back to the
chunks that have the words, so what is known of every token is at hand where its text is; it grows with the corpus.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gridtide.llm import chunks as C, words as W
from gridtide.llm.sending import send
from gridtide.session import stored

CLASSES, OWN, WIDTH, ROUNDS, NOISE = 512, 320, 24, 2, 128  # classes in all; of single words
KINDS = 32  # coarse classes, of the word two before
CODES, CODE_WIDTH, FITTED, FIT_ROUNDS = 512, 16, 20_000, 15  # words with a code, numbers in it, words that centres are fitted on
PART_ROWS = 1 << 20  # trigrams that one task learns from in a round
MODULUS, HELD = 7, 2
BEGIN, REST = 0, 1  # the class before a text, and that of words seen once or never
END_KEY = np.uint64(0x5EED0FE4D)  # stands for the end of a text among the word hashes
LOG10 = np.log(10.0)
BATCH, RATE, LEAST_STEPS = 512, 0.1, 200


class Model(NamedTuple):
    first: np.ndarray  # context vectors of the kind two before, its matrix applied
    second: np.ndarray  # of the class before
    output: np.ndarray
    bias: np.ndarray
    log_sum: np.ndarray  # by context
    sizes: np.ndarray  # training tokens of each class
    unknown: float  # the unknown word's share of its class
    single: float  # that of each word seen once


class Classes(NamedTuple):
    """How words come to their classes."""

    keys: np.ndarray  # sorted hashes of the words with a class of their own
    numbers: np.ndarray  # their classes
    near: np.ndarray  # small table: may a hash have one
    centres: np.ndarray  # of the other classes, which follow
    mean: np.ndarray  # of all vectors, by occurrence
    kinds: np.ndarray  # of all classes


class Tokens:
    """The tokens of one chunk: every text's word hashes, then its end."""

    def __init__(self, texts: pa.Array):
        hasher, keys, counts = W.Hasher(), [], []
        for b in W.blocks(texts, lower=True):
            n = np.diff(b.bounds)
            out = np.full(len(b.starts) + b.rows, END_KEY)
            ends = b.bounds[1:] + np.arange(b.rows)
            is_word = np.ones(len(out), bool)
            is_word[ends] = False
            out[is_word] = hasher(b.data, b.starts, b.ends)
            keys.append(out)
            counts.append(n + 1)
        self.key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.bounds = np.r_[0, np.cumsum(self.counts)]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.bounds[:-1]) if len(self.counts) else np.zeros(0)


def _contexts(classes: np.ndarray, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The classes two before and one before each token."""
    one, two = np.r_[BEGIN, classes[:-1]], np.r_[BEGIN, BEGIN, classes[:-2]][: len(classes)]
    starts = tokens.bounds[:-1]
    one[starts] = BEGIN
    two[starts] = BEGIN
    second = starts[tokens.counts > 1] + 1
    two[second] = BEGIN
    return two, one


def _class_of(keys: np.ndarray, known: np.ndarray, classes: np.ndarray, near: np.ndarray) -> np.ndarray:
    out = np.full(len(keys), REST, np.int64)
    at = np.flatnonzero(near[(keys >> np.uint64(48)).astype(np.int64)])
    if len(known) and len(at):
        i = np.minimum(np.searchsorted(known, keys[at]), len(known) - 1)
        hit = known[i] == keys[at]
        out[at[hit]] = classes[i[hit]]
    return out


def _sum_up(top: int):
    """Totals of every key of a range, sent back to the chunks, and one more row with sums over the range."""

    def work(g: C.Gathered) -> pa.Table:
        keys, inverse = np.unique(g.keys, return_inverse=True)
        total = np.bincount(inverse, g.column("counts"), len(keys)).astype(np.int64)
        best = np.lexsort((keys, -total))[:top]
        best = best[total[best] > 0]
        extra = {"chunk": [None], "part": [None], "totals": [None], "keys": [keys[best].view(np.int64)], "counts": [total[best]]}
        extra |= {"tokens": [int(total.sum())], "words": [int((total > 0).sum())], "ones": [int((total == 1).sum())], "twos": [int((total == 2).sum())]}
        extra = pa.table({c: pa.array(v, COUNTED[c]) for c, v in extra.items()})
        out = g.answer(totals=total[inverse])
        for c in extra.column_names[3:]:
            out = out.append_column(c, pa.nulls(len(out), COUNTED[c]))
        return pa.concat_tables([out.cast(extra.schema), extra])

    return work


COUNTED = {"chunk": pa.int64(), "part": pa.int64(), "totals": pa.list_(pa.int64()), "keys": pa.list_(pa.int64()), "counts": pa.list_(pa.int64()), "tokens": pa.int64(), "words": pa.int64(), "ones": pa.int64(), "twos": pa.int64()}


def _sum_vectors(top: int):
    """The vector of every word of a range (its direction, in steps of 1 / 127), sent back to the chunks, and those of the commonest in one more row."""

    def work(g: C.Gathered) -> pa.Table:
        keys, inverse = np.unique(g.keys, return_inverse=True)
        parts = np.concatenate([_unpacked(x, n) for x, n in zip(g.table["sums"].to_pylist(), g.sizes)])
        sums = np.zeros((len(keys), parts.shape[1]))
        np.add.at(sums, inverse, parts)
        counts = np.zeros(len(keys), np.int64)
        counts[inverse] = g.column("totals")
        vectors = directions(sums / np.maximum(counts, 1)[:, None])
        best = np.lexsort((keys, -counts))[:top]
        answer = pa.array([vectors[inverse[a:b]].tobytes() for a, b in zip(g.bounds[:-1], g.bounds[1:])], pa.binary())
        out = pa.table({"chunk": g.table["chunk"], "part": g.table["part"], "vectors": answer, "keys": pa.nulls(len(g.sizes), pa.list_(pa.int64())), "counts": pa.nulls(len(g.sizes), pa.list_(pa.int64()))})
        extra = pa.table({"chunk": pa.nulls(1, pa.int64()), "part": pa.nulls(1, pa.int64()), "vectors": pa.array([vectors[best].tobytes()], pa.binary()), "keys": pa.array([keys[best].view(np.int64)], pa.list_(pa.int64())), "counts": pa.array([counts[best]], pa.list_(pa.int64()))})
        return pa.concat_tables([out.cast(extra.schema), extra])

    return work


def _packed(sums: np.ndarray) -> bytes:
    """Rows of whole numbers in as few bytes each as the largest needs; most words are rare."""
    top = np.abs(sums).max(initial=0)
    return sums.astype(np.int8 if top < 128 else np.int16 if top < 32768 else np.int32).tobytes()


def _unpacked(packed: bytes, rows: int) -> np.ndarray:
    kind = {1: np.int8, 2: np.int16, 4: np.int32}[len(packed) // (rows * 2 * CODE_WIDTH)]
    return np.frombuffer(packed, kind).reshape(rows, -1).astype(np.int32)


def directions(vectors: np.ndarray) -> np.ndarray:
    size = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    return np.rint(127 * vectors / np.maximum(size, 1e-9)).astype(np.int8)


def codes(n: int, width: int = CODE_WIDTH) -> np.ndarray:
    """Random signs for each of the commonest words, in their order; no signs for the others (the last row)."""
    out = np.random.default_rng(11).choice(np.array([-1, 1], np.int32), (n + 1, width))
    out[n] = 0
    return out


def fit_centres(vectors: np.ndarray, weights: np.ndarray, n: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """The directions of n groups of vectors; the first ones start at the vectors with the largest weights."""
    units = vectors / np.maximum(np.sqrt((vectors**2).sum(axis=1, keepdims=True)), 1e-9)
    order = np.argsort(-weights, kind="stable")
    centres = units[order[:n]].copy()
    for _ in range(rounds if len(centres) else 0):
        group = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, group, units * weights[:, None])
        size = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centres)
    return centres


def _start(classes: int, width: int) -> np.ndarray:
    """Parameters in one array of classes x (3 width + 1): two context tables, the output table and the bias."""
    rng = np.random.default_rng(7)
    out = rng.normal(0, 0.1, (classes, 3 * width + 1))
    out[:, -1] = 0
    return out


def pieces_of(count: np.ndarray, rng: np.random.Generator, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rows in random order and their weights, on average 1 or less. Counts above the mean are cut into equal pieces, so
    steps stay small, and every pass (as many as give `least` pieces) holds all occurrences exactly once."""
    mean = count.sum() / len(count)
    cuts = np.ceil(count / mean).astype(np.int64)
    rows = np.repeat(np.arange(len(count)), cuts)
    order = np.concatenate([rng.permutation(len(rows)) for _ in range(max(1, -(-least // len(rows))))])
    return rows[order], (count / cuts / mean)[rows[order]]


def nce_steps(params: np.ndarray, code: np.ndarray, count: np.ndarray, unigram: np.ndarray, seed: int, noise: int = NOISE, batch: int = BATCH, rate: float = RATE) -> np.ndarray:
    """One pass over all trigrams by AdaGrad; each batch is set against `noise` classes drawn from the unigram shares."""
    classes, width = len(params), (params.shape[1] - 1) // 3
    rng = np.random.default_rng(seed)
    a, b, c = code // classes**2, code // classes % classes, code % classes
    p, seen = params.copy(), np.full(params.shape, 1e-8)
    log_noise = np.log(noise * np.maximum(unigram, 1e-12))
    drawn, share = pieces_of(count, rng, LEAST_STEPS * batch)
    for lo in range(0, len(drawn), batch):
        i, weight = drawn[lo : lo + batch], share[lo : lo + batch, None]
        x, y, w = a[i], b[i], c[i]
        z = rng.choice(classes, noise, p=unigram)
        h = p[x, :width] + p[y, width : 2 * width]
        q, qz = p[w, 2 * width : 3 * width], p[z, 2 * width : 3 * width]
        good = 1 / (1 + np.exp(-np.clip((h * q).sum(1) + p[w, -1] - log_noise[w], -30, 30))) - 1
        good *= weight[:, 0]
        bad = weight / (1 + np.exp(-np.clip(h @ qz.T + p[z, -1] - log_noise[z], -30, 30)))
        slope = np.zeros_like(p)
        to_h = good[:, None] * q + bad @ qz
        np.add.at(slope[:, :width], x, to_h)
        np.add.at(slope[:, width : 2 * width], y, to_h)
        np.add.at(slope[:, 2 * width :], w, np.c_[good[:, None] * h, good])
        np.add.at(slope[:, 2 * width :], z, np.c_[bad.T @ h, bad.sum(0)])
        slope /= len(i)
        seen += slope**2
        p -= rate * slope / np.sqrt(seen)
    return p


def _log_sums(first: np.ndarray, second: np.ndarray, output: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The logarithm of the sum over all classes, for every context."""
    out = np.empty((len(first), len(second)))
    for x in range(len(first)):
        scores = (first[x] + second) @ output.T + bias
        top = scores.max(axis=1, keepdims=True)
        out[x] = top[:, 0] + np.log(np.exp(scores - top).sum(axis=1))
    return out


def score(
    docs: DataFrame, id: str = "doc_id", text: str = "text", classes: int = CLASSES, own: int = OWN, width: int = WIDTH, rounds: int = ROUNDS, part_rows: int = PART_ROWS, chunk_bytes: int = C.CHUNK_BYTES
) -> DataFrame:
    """One row per row of `docs`: `id, held_out, n_tokens, n_known, train_tokens, base_score, score`.

    Learns from the rows whose crc32 of the id as text leaves a remainder other than 2 by 7 (null id: the empty text).
    Tokens: words outside white space with A-Z lower-cased, then one end; a null or empty text is an end alone.
    `base_score` sums log10((c + 1) / (N + V + 1)), `score` is the model's log10 probability, every word that training rows do not have being the one unknown word.
    Repeated rows count each. `classes` is the number of classes in all, `own` of them of single words. Centres of the others are fitted on
    the vectors of at most 20,000 common words. Without training rows every count is 0 and only the unknown word is expected.
    """
    held = F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % MODULUS == HELD
    kept, n = C.store(docs.select(F.col(id), held.alias("held"), F.col(text).alias("text")), "text", chunk_bytes)
    own = max(1, min(own, classes - 3))
    shortlist = max(CODES, own)

    def emit(batches):
        for batch in batches:
            for chunk, payload in zip(batch["chunk"].to_pylist(), batch["payload"]):
                table, tokens, learned = _opened(payload)
                keys, inverse = np.unique(tokens.key, return_inverse=True)
                rows = C.by_range(chunk, keys, n, counts=np.bincount(inverse[learned], minlength=len(keys)).astype(np.int64))
                if rows is not None:
                    yield rows

    counted = kept.mapInArrow(emit, "chunk long, part long, keys array<long>, counts array<long>")
    kinds = "chunk long, part long, totals array<long>, keys array<long>, counts array<long>, tokens long, words long, ones long, twos long"
    counted = stored(C.settle(counted, _sum_up(shortlist), kinds), "counts")
    sums = counted.filter("chunk IS NULL")
    total, vocabulary, ones, twos = (int(x or 0) for x in sums.agg(F.sum("tokens"), F.sum("words"), F.sum("ones"), F.sum("twos")).first())
    common = _commonest(sums, "counts", shortlist, n).select("keys", "counts").toPandas()
    # Words seen once have no class of their own.
    common = common[common["counts"] > 1]
    coded = common["keys"].to_numpy(np.int64)[:CODES].view(np.uint64)
    alone = common["keys"].to_numpy(np.int64)[:own].view(np.uint64)
    answers = counted.filter("chunk IS NOT NULL").select("chunk", "part", "totals")
    by_chunk = kept.select("chunk", "payload").groupBy("chunk").cogroup(answers.groupBy("chunk"))

    def emit_vectors(key, left, right):
        for chunk, payload in zip(left["chunk"].to_pylist(), left["payload"]):
            _, tokens, learned = _opened(payload)
            found = _vectors(tokens, learned, right, coded)
            rows = None if found is None else C.by_range(chunk, found[0], n, totals=found[1])
            if rows is not None:
                cuts = np.r_[0, np.cumsum(rows["keys"].value_lengths().to_numpy())]
                sums_ = pa.array([_packed(found[2][a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())
                return pa.Table.from_batches([rows.append_column("sums", sums_)])
        kinds = {"chunk": pa.int64(), "part": pa.int64(), "keys": pa.list_(pa.int64()), "totals": pa.list_(pa.int64()), "sums": pa.binary()}
        return pa.table({c: pa.array([], t) for c, t in kinds.items()})

    vectors = by_chunk.applyInArrow(emit_vectors, "chunk long, part long, keys array<long>, totals array<long>, sums binary")
    vectors = stored(C.settle(vectors, _sum_vectors(-(-4 * FITTED // n) + 8), "chunk long, part long, vectors binary, keys array<long>, counts array<long>"), "vectors")
    how = _classes(vectors, alone, classes - own - 2)
    size = len(alone) + 2 + len(how.centres)
    sent_how = send(docs.sparkSession, how)

    def nearest(batches):
        how = sent_how()
        for batch in batches:
            labels = [_nearest(np.frombuffer(v.as_buffer(), np.int8).reshape(-1, 2 * CODE_WIDTH), how).tobytes() for v in batch["vectors"]]
            yield pa.RecordBatch.from_pydict({"chunk": batch["chunk"], "part": batch["part"], "labels": pa.array(labels, pa.binary())})

    # Two bytes for each word go back to its chunks, not its vector.
    labels = stored(vectors.filter("chunk IS NOT NULL").select("chunk", "part", "vectors").mapInArrow(nearest, "chunk long, part long, labels binary"), "labels")
    parts = answers.select("chunk", "part", F.lit(1).alias("step"), "totals", F.lit(None).cast("binary").alias("labels"))
    parts = parts.unionAll(labels.select("chunk", "part", F.lit(2), F.lit(None).cast("array<bigint>"), "labels"))
    known = kept.select("chunk", "payload").groupBy("chunk").cogroup(parts.groupBy("chunk"))

    def trigrams(key, left, right):
        _, tokens, learned = _opened(left["payload"][0])
        cls, _ = _token_classes(tokens, right, sent_how())
        two, one = _contexts(cls, tokens)
        found, times = np.unique(((sent_how().kinds[two] * size + one) * size + cls)[learned], return_counts=True)
        return pa.table({"code": pa.array(found, pa.int64()), "n": pa.array(times, pa.int64())})

    seen = stored(known.applyInArrow(trigrams, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "trigrams")
    model = _train(seen, size, int(how.kinds.max()) + 1, ones, twos, width, rounds, part_rows)
    sent = send(docs.sparkSession, model)  # tables of fixed size

    def judge(key, left, right):
        table, tokens, _ = _opened(left["payload"][0])
        cls, count = _token_classes(tokens, right, sent_how())
        return pa.table({
            "id": table[id], "held_out": table["held"], "n_tokens": pa.array(tokens.counts), "n_known": pa.array(tokens.per_text((count > 0).astype(np.int64)).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(tokens.counts), total, np.int64)), "base_score": pa.array(tokens.per_text(np.log10(count + 1.0)) - tokens.counts * np.log10(total + vocabulary + 1.0)),
            "score": pa.array(tokens.per_text(_log_probability(sent(), tokens, sent_how().kinds, cls, count))),
        })

    kind = docs.schema[id].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("held_out", T.BooleanType())] + [T.StructField(x, T.LongType()) for x in ("n_tokens", "n_known", "train_tokens")] + [T.StructField(x, T.DoubleType()) for x in ("base_score", "score")])
    return known.applyInArrow(judge, schema).withColumnRenamed("id", id)


def _opened(payload) -> tuple[pa.Table, Tokens, np.ndarray]:
    """A chunk's rows and tokens, and which tokens are learned from."""
    table = C.unpack(payload.as_buffer())
    tokens = Tokens(table["text"].combine_chunks())
    return table, tokens, np.repeat(~table["held"].to_numpy(), tokens.counts)


def _commonest(sums: DataFrame, counts: str, top: int, n: int) -> DataFrame:
    """The `top` commonest entries of the ranges' lists, most frequent first; only a few of each list beyond its share are sorted."""
    few = 2 * top // n + 8
    floor = sums.select(F.explode(F.slice(counts, 1, few)).alias("count")).orderBy(F.desc("count")).limit(top).agg(F.min("count")).first()[0] or 0
    entries = F.filter(F.arrays_zip("keys", counts), lambda x: x[counts] >= floor)
    return sums.select(F.inline(entries)).orderBy(F.desc(counts), "keys").limit(top)


def _totals(right: pa.Table, keys: int) -> np.ndarray:
    """The settled counts of a chunk's distinct words, in their order."""
    return right.sort_by("part")["totals"].combine_chunks().flatten().to_numpy() if keys else np.zeros(0, np.int64)


def _vectors(tokens: Tokens, learned: np.ndarray, right: pa.Table, coded: np.ndarray):
    """Words seen twice at least, their settled counts, and the sums of their neighbours' codes in this chunk's training rows."""
    keys, inverse = np.unique(tokens.key, return_inverse=True)
    if not len(keys):
        return None
    totals = _totals(right, len(keys))
    wanted = totals > 1
    if not wanted.any():
        return None
    order = np.argsort(coded)
    at = np.minimum(np.searchsorted(coded[order], keys), max(len(coded) - 1, 0))
    number = np.where(coded[order][at] == keys, order[at], len(coded)) if len(coded) else np.zeros(len(keys), np.int64)
    code, word = codes(len(coded)), number[inverse]
    starts = np.zeros(len(word), bool)
    starts[tokens.bounds[:-1]] = True
    before = np.where(starts, len(coded), np.r_[len(coded), word[:-1]])
    after = np.where(np.r_[starts[1:], True], len(coded), np.r_[word[1:], len(coded)])
    place = np.cumsum(wanted) - 1
    use = np.flatnonzero(learned & wanted[inverse])
    row, n = place[inverse[use]], int(wanted.sum())
    # Each side adds up by word and common neighbour first: codes are applied to those counts.
    sums = []
    for side in (before, after):
        near = side[use]
        some = near < len(coded)
        pair, times = np.unique(row[some] * (len(coded) + 1) + near[some], return_counts=True)
        out = np.zeros((n, code.shape[1]), np.int64)
        np.add.at(out, pair // (len(coded) + 1), code[pair % (len(coded) + 1)] * times[:, None])
        sums.append(out)
    return keys[wanted], totals[wanted], np.concatenate(sums, axis=1).astype(np.int32)


def _classes(vectors: DataFrame, alone: np.ndarray, groups: int) -> Classes:
    """Centres from the vectors of the commonest words; a bounded number comes to the driver."""
    rows = vectors.filter("chunk IS NULL").select("keys", "counts", "vectors").toArrow()
    counts = rows["counts"].combine_chunks().flatten().to_numpy().astype(float) if rows.num_rows else np.zeros(0)
    keys = rows["keys"].combine_chunks().flatten().to_numpy().view(np.uint64) if rows.num_rows else np.zeros(0, np.uint64)
    found = np.frombuffer(b"".join(rows["vectors"].to_pylist()), np.int8).reshape(len(counts), 2 * CODE_WIDTH).astype(float)
    best = np.lexsort((keys, -counts))[:FITTED]
    keys, found, counts = keys[best], found[best], counts[best]
    mean = (found * counts[:, None]).sum(axis=0) / max(counts.sum(), 1)
    centred, own = found - mean, np.isin(keys, alone)
    centres = fit_centres(centred[~own], np.sqrt(counts[~own]), max(1, groups)) if (~own).any() else np.zeros((1, 2 * CODE_WIDTH))
    # Kinds of the classes, after those of the place before a text and of words seen once.
    coarse = fit_centres(centred, np.sqrt(counts), min(KINDS - 2, len(alone) + len(centres))) if len(found) else np.zeros((1, 2 * CODE_WIDTH))
    kinds = np.zeros(2 + len(alone) + len(centres), np.int64)
    kinds[REST] = 1
    place = {k: i for i, k in enumerate(keys.tolist())}
    for i, k in enumerate(alone.tolist()):
        kinds[REST + 1 + i] = 2 + int((coarse @ centred[place[k]]).argmax()) if k in place else 1
    kinds[2 + len(alone) :] = 2 + (centres @ coarse.T).argmax(axis=1)
    order = np.argsort(alone)
    near = np.zeros(1 << 16, bool)
    near[(alone >> np.uint64(48)).astype(np.int64)] = True
    return Classes(alone[order], order + REST + 1, near, centres, mean, kinds)


def _nearest(vectors: np.ndarray, how: Classes) -> np.ndarray:
    """The number of the centre nearest to each vector."""
    out = np.empty(len(vectors), np.uint16)
    for lo in range(0, len(vectors), 1 << 14):
        out[lo : lo + (1 << 14)] = ((vectors[lo : lo + (1 << 14)].astype(float) - how.mean) @ how.centres.T).argmax(axis=1)
    return out


def _token_classes(tokens: Tokens, right: pa.Table, how: Classes) -> tuple[np.ndarray, np.ndarray]:
    """The class and the settled count of every token of a chunk, from the answers of both steps."""
    keys, inverse = np.unique(tokens.key, return_inverse=True)
    step = right["step"].to_numpy()
    totals = _totals(right.filter(pa.array(step == 1)), len(keys))
    cls = _class_of(keys, how.keys, how.numbers, how.near)
    wanted = np.flatnonzero(totals > 1)
    if len(wanted):
        label = np.frombuffer(b"".join(right.filter(pa.array(step == 2)).sort_by("part")["labels"].to_pylist()), np.uint16)
        cls[wanted] = np.where(cls[wanted] == REST, len(how.keys) + 2 + label.astype(np.int64), cls[wanted])
    return cls[inverse], totals[inverse]


def _log_probability(m: Model, tokens: Tokens, kinds: np.ndarray, cls: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The log10 probability of each token: of its class, and of the word within it."""
    two, one = _contexts(cls, tokens)
    two = kinds[two]
    out = np.empty(len(cls))
    for lo in range(0, len(cls), 1 << 16):
        s = slice(lo, lo + (1 << 16))
        out[s] = np.einsum("ij,ij->i", m.first[two[s]] + m.second[one[s]], m.output[cls[s]]) + m.bias[cls[s]] - m.log_sum[two[s], one[s]]
    share = np.where(cls == REST, np.where(count > 0, m.single, m.unknown), np.maximum(count, 1) / np.maximum(m.sizes[cls], 1))
    return out / LOG10 + np.log10(share)


def _train(seen: DataFrame, size: int, kinds: int, ones: int, twos: int, width: int, rounds: int, part_rows: int) -> Model:
    """Fit the class model on all trigrams, in parts of about `part_rows` rows."""
    by_class = {r[0]: r[1] for r in seen.groupBy((F.col("code") % size).alias("c")).agg(F.sum("n")).collect()}  # a row for each class
    sizes = np.zeros(size)
    for c, k in by_class.items():
        sizes[c] = k
    parts = max(1, -(-seen.count() // part_rows))
    dealt = seen.withColumn("part", F.pmod(F.xxhash64("code"), F.lit(parts)))
    unigram = sizes + 1e-9 * (np.arange(size) != BEGIN)
    unigram = unigram / unigram.sum()
    params = _start(size, width)
    params[:, -1] = np.log(np.maximum(unigram, 1e-12))

    def learner(params: np.ndarray, step: int):
        def learn(key, table):
            table, part = table.sort_by("code"), key[0].as_py()
            count = table["n"].to_numpy()
            found = nce_steps(params, table["code"].to_numpy(), count.astype(float), unigram, 1000 * step + part)
            return pa.table({"part": pa.array([part], pa.int64()), "n": pa.array([int(count.sum())], pa.int64()), "params": pa.array([found.astype(np.float32).tobytes()], pa.binary())})

        return learn

    for step in range(rounds):
        learned = sorted(dealt.groupBy("part").applyInArrow(learner(params, step), "part long, n long, params binary").collect())  # as many as there are parts
        if not learned:
            break
        weight = np.array([x["n"] for x in learned], float)
        params = sum(w * np.frombuffer(x["params"], np.float32).reshape(size, -1).astype(float) for w, x in zip(weight / weight.sum(), learned))
    first, second, output, bias = params[:kinds, :width], params[:, width : 2 * width], params[:, 2 * width : 3 * width], params[:, -1].copy()
    bias[BEGIN] = -1e9  # never predicted
    unknown = (ones + 1) / (ones + 2 * twos + 2) if ones else 1.0
    return Model(first, second, output, bias, _log_sums(first, second, output, bias), sizes, unknown, (1 - unknown) / max(ones, 1))
