"""A hidden Markov language model, trained by Baum-Welch counts aggregated across partitions.

Every word seen in training has an emission probability of its own in every state, so what training gathers grows with the vocabulary.  A
model of word classes of fixed size is trained first and only starts the states: a state emits a class, the class emits the word by
its share of the class, P(word | state) = P(class | state) * count(word) / count(class).  Words with at least ``FREQUENT`` of all training
tokens are classed by hash, the others by their last bytes, which tell languages and word forms apart.  Then ``WORD_ITERATIONS``
of Baum-Welch reestimate each word by itself, the class counting as ``PRIOR`` further occurrences of the word.  The end of a text is a
symbol; words never seen in training are one event of their own, with the Good-Turing share of the words seen once.

Corpus counts: a tile of documents asks once per distinct word, buckets of words add up and answer every tile (``tiles_of_text``), and
the tile writes each document as a row of class numbers and of word numbers within the tile.  Every iteration reads those rows and runs the
scaled forward-backward recursion on many sequences at once.  The classes' expected counts are added by shuffling (partitions first
by salted groups), and the sums, of fixed size, reach the driver.  Those of words never do: a tile sends each bucket the states' shares
of its words, the bucket adds them up by word and answers every tile; the driver gets sums over all words.  Shares travel in half
precision; a state's emissions are normalised by the sum of what is sent, so they add up to 1.  Training cuts texts into segments of
``SEGMENT`` tokens (all of them are used; a segment that continues a text starts from the states' overall shares).  Scoring runs the exact
scaled forward recursion over whole texts in double precision.

Defined cases: a null or empty text is the end token alone; rows without id train and are scored (their fold is that of an empty id); without
training rows every token is unknown and scores as such; an empty table gives an empty table; repeated rows count as documents
of their own; other columns do not matter.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import textbatch as tb
from tidegrid.llm import tiles_of_text as tt
from tidegrid.llm.frames import col, stage_only, unstage

FOLDS, HELD_FOLD = 7, 2
STATES, ITERATIONS, SEGMENT = 8, 5, 256
SIDE_BY_SIDE, TEXTS_BY_SIDE = 4096, 1024  # segments and whole texts that one recursion takes: memory against calls
WORD_ITERATIONS, PRIOR = 3, 1.0
FREQUENT = 2e-5
FREQUENT_CLASSES, FORM_CLASSES = 4096, 4096
WORD_CLASSES = FREQUENT_CLASSES + FORM_CLASSES
END, UNKNOWN = WORD_CLASSES, WORD_CLASSES + 1
CLASSES = WORD_CLASSES + 2
SMOOTHING = 100.0
OWN_END, OWN_UNKNOWN, OWN_WORDS = 0, 1, 2  # word numbers within a tile: the tile's words, in order of their fingerprints, begin at OWN_WORDS
SEED_TEXTS = 96

# ---- counts and encoding --------------------------------------------------------------------------------------------

_ASK = pa.schema([("bucket", pa.int32()), ("tile", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_ASK_DDL = "bucket int, tile int, keys binary, counts binary"
_TELL = pa.schema([("tile", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary()), ("distinct", pa.int64()), ("once", pa.int64())])
_TELL_DDL = "tile int, bucket int, counts binary, distinct long, once long"
_DOC = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("log_next", pa.float64()), ("log_count", pa.float64()),
     ("classes", pa.binary()), ("distinct", pa.int64()), ("once", pa.int64()), ("tile", pa.int32()), ("words", pa.binary()),
     ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("kinds", pa.binary())]
)
_DOC_DDL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, log_next double, log_count double, classes binary, distinct long, once long, "
    "tile int, words binary, bucket int, keys binary, counts binary, kinds binary"
)
_SENT = pa.schema([("bucket", pa.int32()), ("tile", pa.int32()), ("shares", pa.binary())])
_SENT_DDL = "bucket int, tile int, shares binary"
_TOLD = pa.schema([("tile", pa.int32()), ("bucket", pa.int32()), ("shares", pa.binary()), ("sums", pa.list_(pa.float64()))])
_TOLD_DDL = "tile int, bucket int, shares binary, sums array<double>"


def held_out(id_column: Column, folds: int = FOLDS, fold: int = HELD_FOLD) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds == fold


def _words_of(documents: pa.Table):
    held = documents.column("held_out").to_numpy(zero_copy_only=False)
    for row, to, data, offsets in tb.chunks(documents.column("text"), 4 * tb.CHUNK_BYTES):
        yield row, tb.words(data, offsets, lower=True), held[row:to]


def _ask(buckets: int):
    def ask(documents: pa.Table) -> pa.Table:
        keys, train = [], []
        for _, w, held in _words_of(documents):
            keys.append(w.hashes)
            train.append(~held[w.text_of()])
        keys, train = np.concatenate(keys), np.concatenate(train)  # the parts go before sorting takes its memory
        words, place = np.unique(keys, return_inverse=True)
        del keys
        counts = np.bincount(place[train], minlength=len(words)).astype(np.uint32)
        return tt.table(tt.sent(documents.column("tile")[0].as_py(), buckets, words, counts), _ASK)

    return ask


def _tell(asked: pa.Table) -> pa.Table:
    """The corpus count of every word, in the order asked; and, for a tile of no documents, how many words and how many seen once."""
    keys, sizes = tt.unpacked(asked.column("keys"), np.uint64)
    counts, _ = tt.unpacked(asked.column("counts"), np.uint32)
    words, place = np.unique(keys, return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(words)).astype(np.int64)
    bucket, rows, at = asked.column("bucket")[0].as_py(), [], 0
    answer = total[place]
    for tile, size in zip(asked.column("tile").to_pylist(), sizes, strict=True):
        rows.append((tile, bucket, tb.pack(answer[at : at + size]), 0, 0))
        at += size
    rows.append((-1, bucket, b"", int((total > 0).sum()), int((total == 1).sum())))
    return tt.table(rows, _TELL)


def _forms(w: tb.Words, some: np.ndarray) -> np.ndarray:
    """A class from the last three bytes of some words."""
    starts, ends = w.starts[some], w.ends[some]
    out = np.zeros(len(some), np.uint64)
    for back in (1, 2, 3):
        at = ends - back
        byte = np.where(at >= starts, w.data[np.maximum(at, 0)], 0).astype(np.uint64)
        out = out * np.uint64(257) + byte
    return (tb.mix(out) % np.uint64(FORM_CLASSES)).astype(np.int64)


def _encode(tokens: int, train_docs: int, buckets: int):
    frequent = max(2.0, FREQUENT * tokens)

    def encode(documents: pa.Table, told: pa.Table) -> pa.Table:
        if documents.num_rows == 0:
            distinct, once = (sum(told.column(c).to_pylist()) for c in ("distinct", "once"))
            return tt.table([(None, None, 0, 0, 0.0, 0.0, None, distinct, once, *[None] * 6)], _DOC)
        tile = documents.column("tile")[0].as_py()
        ids = documents.column("doc_id").to_numpy()
        found = list(_words_of(documents))
        keys = np.concatenate([w.hashes for _, w, _ in found])
        for _, w, _ in found:
            w.hashes = keys[:0]  # one copy of the fingerprints is enough
        words, places = np.unique(keys, return_inverse=True)
        del keys
        places = places.astype(np.int32)
        order = np.argsort(told.column("bucket").to_numpy())
        answers = told.column("counts").to_pylist()
        known = np.frombuffer(b"".join(answers[i] for i in order), np.int64)
        end_next, end_log = math.log10(train_docs + 1), 0.0
        first = np.empty(len(words), np.int64)  # where each word of the tile stands first
        first[places[::-1]] = np.arange(len(places) - 1, -1, -1, dtype=np.int32)
        kinds = np.where(known >= frequent, (words % np.uint64(FREQUENT_CLASSES)).astype(np.int64), UNKNOWN)
        ends = np.cumsum([len(w.starts) for _, w, _ in found])
        for (_, w, _), end in zip(found, ends, strict=True):
            here = np.flatnonzero((known > 0) & (known < frequent) & (first < end) & (first >= end - len(w.starts)))
            kinds[here] = FREQUENT_CLASSES + _forms(w, first[here] - (end - len(w.starts)))
        kinds = kinds.astype(np.uint16)
        own_number = np.where(known > 0, np.arange(len(words)) + OWN_WORDS, OWN_UNKNOWN).astype(np.uint32)
        log_next, log_count = np.log10(known + 1.0), np.log10(np.maximum(known, 1))
        rows, trained = [], np.zeros(len(words), np.uint32)
        for (row, w, held), end in zip(found, ends, strict=True):
            place = places[end - len(w.starts) : end]
            classes, numbers = kinds[place], own_number[place]
            trained += np.bincount(place[~held[w.text_of()]], minlength=len(words)).astype(np.uint32)
            logs = np.append(0.0, np.cumsum(log_next[place]))
            shares = np.append(0.0, np.cumsum(log_count[place]))
            seen = np.append(0, np.cumsum(known[place] > 0))
            for text, is_held in enumerate(held):
                a, b = w.first[text], w.first[text + 1]
                own = np.append(classes[a:b], np.uint16(END))
                rows.append(
                    (int(ids[row + text]), bool(is_held), int(b - a + 1), int(seen[b] - seen[a]) + (train_docs > 0), float(logs[b] - logs[a]) + end_next,
                     float(shares[b] - shares[a]) + end_log, own.tobytes(), 0, 0, tile, np.append(numbers[a:b], np.uint32(OWN_END)).tobytes(), *[None] * 4)
                )
        for bucket, _, *packed in tt.sent(tile, buckets, words, trained, kinds):
            rows.append((None, None, 0, 0, 0.0, 0.0, None, 0, 0, tile, None, bucket, *packed))
        return tt.table(rows, _DOC)

    return encode


class Corpus(NamedTuple):
    rows: DataFrame
    tokens: int
    distinct: int
    once: int
    texts: int
    asked: DataFrame  # bucket, tile, keys, counts, kinds: the words of every tile


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Corpus:
    """Every document as a row of class numbers, and the sizes of the training corpus."""
    own = col(id_col).cast("long")
    text = F.coalesce(col(text_col), F.lit(""))
    buckets = tiles = tt.parts(docs, 1)

    def count(batches):
        words = texts = 0
        for batch in batches:
            for _, _, data, offsets in tb.chunks(batch.column(0)):
                words += tb.number_of_words(data, offsets)
                texts += len(offsets) - 1
        yield pa.RecordBatch.from_arrays([pa.array([words]), pa.array([texts])], names=["words", "texts"])

    sizes = docs.filter(~held_out(own)).select(text.alias("text")).mapInArrow(count, "words long, texts long").agg(F.sum("words"), F.sum("texts")).first()
    words, train_docs = (int(x or 0) for x in sizes)
    texts = docs.select(own.alias("doc_id"), text.alias("text"), held_out(own).alias("held_out"))
    texts = texts.withColumn("tile", F.pmod(F.xxhash64("doc_id", "text"), F.lit(tiles)).cast("int"))
    texts = texts.withColumn("doc_id", F.coalesce("doc_id", F.lit(int(tt.NO_ID))))
    told = texts.groupBy("tile").applyInArrow(_ask(buckets), _ASK_DDL).groupBy("bucket").applyInArrow(_tell, _TELL_DDL)
    rows = texts.groupBy("tile").cogroup(told.groupBy("tile")).applyInArrow(_encode(words + train_docs, train_docs, buckets), _DOC_DDL)
    rows = stage_only(rows, "hmm-encoded")
    distinct, once = rows.filter("classes IS NULL AND bucket IS NULL").agg(F.sum("distinct"), F.sum("once")).first()
    asked = rows.filter("bucket IS NOT NULL").select("bucket", "tile", "keys", "counts", "kinds")
    texts = rows.filter("classes IS NOT NULL").drop("distinct", "once", *asked.columns[2:], "bucket")
    return Corpus(texts, words + train_docs, int(distinct or 0) + (train_docs > 0), int(once or 0), train_docs, asked)


# ---- the model ------------------------------------------------------------------------------------------------------


class Model(NamedTuple):
    start: np.ndarray  # (states,)
    overall: np.ndarray  # (states,): shares of the states, where a segment continues a text
    step: np.ndarray  # (states, states)
    emit: np.ndarray  # (classes, states)


def normalised(counts: dict[str, np.ndarray], smoothing: float = SMOOTHING) -> Model:
    """Parameters from expected counts; emissions are smoothed towards the classes' shares of the corpus."""
    emit = counts["emit"]
    share = emit.sum(axis=1, keepdims=True) + 1e-6
    share /= share.sum()
    emit = emit + smoothing * share
    step = counts["step"] + 1.0
    start = counts["start"] + 1.0
    overall = counts["emit"].sum(axis=0) + 1.0
    return Model(start / start.sum(), overall / overall.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def side_by_side(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sequences by falling length, all first tokens, then all second ones and so on without padding: their order, how many
    sequences reach each step, where each step begins, and the tokens."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    active = np.searchsorted(-lengths, -np.arange(1, int(lengths[0]) + 1), side="right")
    begin = np.append(0, np.cumsum(active))
    step = np.arange(begin[-1]) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    tokens = np.empty(begin[-1], np.int64)
    tokens[begin[step] + np.repeat(np.arange(len(order)), lengths)] = np.concatenate([sequences[i] for i in order])
    return order, active, begin, tokens


def emitted(emit: np.ndarray, tokens: np.ndarray, dtype) -> np.ndarray:
    """(states, tokens): what every state gives each token."""
    out = np.empty((emit.shape[1], len(tokens)), dtype)
    for j, of_state in enumerate(emit.T):
        np.take(np.ascontiguousarray(of_state, dtype), tokens, out=out[j], mode="clip")
    return out


def expected_counts(model: Model, sequences: list[np.ndarray], begins: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Baum-Welch counts of sequences; ``begins`` tells which begin a text.

    States are rows and tokens columns, step after step, so that every operation runs along many sequences.
    """
    order, active, begin, tokens = side_by_side(sequences)
    states = len(model.start)
    seen = emitted(model.emit, tokens, np.float32)
    step = model.step.astype(np.float32)
    into = np.ascontiguousarray(step.T)
    alpha, scale = np.empty_like(seen), np.empty(len(tokens), np.float32)
    for t, n in enumerate(active):
        here = slice(begin[t], begin[t] + n)
        now = alpha[:, here]
        if t:
            np.matmul(into, alpha[:, begin[t - 1] : begin[t - 1] + n], out=now)
        else:
            now[:] = np.where(begins[order], model.start[:, None], model.overall[:, None])
        now *= seen[:, here]
        now /= np.add.reduce(now, axis=0, out=scale[here])
    seen /= scale
    transitions = np.zeros((states, states))
    beta = np.ones((states, len(order)), np.float32)
    for t in range(len(active) - 1, -1, -1):
        here, later = slice(begin[t], begin[t + 1]), beta[:, : active[t]]
        posterior, back = alpha[:, here], seen[:, here]
        back *= later
        posterior *= later
        posterior /= np.add.reduce(posterior, axis=0)
        if t:
            transitions += alpha[:, begin[t - 1] : begin[t - 1] + active[t]] @ back.T
            np.matmul(step, back, out=later)
    emit = np.stack([np.bincount(tokens, weights=of_state, minlength=len(model.emit)) for of_state in alpha], axis=1)
    start = alpha[:, : len(order)][:, begins[order]].sum(axis=1, dtype=np.float64)
    return {"emit": emit, "step": transitions * model.step, "start": start}, float(np.log(scale).sum(dtype=np.float64))


def _segments(texts: list[bytes], size: int, kind=np.uint16) -> tuple[list[np.ndarray], np.ndarray]:
    out, begins = [], []
    for packed in texts:
        own = np.frombuffer(packed, kind)  # training texts have no unknown words
        for at in range(0, len(own), size):
            out.append(own[at : at + size])
            begins.append(at == 0)
    return out, np.array(begins)


def _packed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([counts["emit"].reshape(-1), counts["step"].reshape(-1), counts["start"], counts["extra"]])


def _summed(rows: DataFrame) -> np.ndarray:
    """Add the partitions' vectors, cut into slots: first within salted groups, then per slot; the sums are of fixed size."""

    def add(table: pa.Table) -> pa.Table:
        values = table.column("values").to_pylist()
        total = np.frombuffer(values[0], np.float64).copy()
        for v in values[1:]:
            total += np.frombuffer(v, np.float64)
        return pa.table({"slot": pa.array([table.column("slot")[0].as_py()], pa.int32()), "values": pa.array([total.tobytes()], pa.binary())})

    once = rows.groupBy("slot", "salt").applyInArrow(add, "slot int, values binary")
    found = {slot: values for slot, values in once.groupBy("slot").applyInArrow(add, "slot int, values binary").collect()}
    return np.concatenate([np.frombuffer(found[slot], np.float64) for slot in sorted(found)]) if found else np.empty(0)


_SLOT = 8192
_SLOT_DDL = "slot int, salt int, values binary"


def _slots(vector: np.ndarray, spread: int = 32) -> pa.RecordBatch:
    rows = [vector[at : at + _SLOT].tobytes() for at in range(0, len(vector), _SLOT)]
    salt = TaskContext.get().partitionId() % spread
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(rows)), pa.int32()), pa.array([salt] * len(rows), pa.int32()), pa.array(rows, pa.binary())], names=["slot", "salt", "values"]
    )


def class_counts(train: DataFrame) -> np.ndarray:
    def count(batches):
        total = np.zeros(CLASSES)
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint16)
            total += np.bincount(flat, minlength=CLASSES)
        yield _slots(total)

    found = _summed(train.select("classes").mapInArrow(count, _SLOT_DDL))
    return found if len(found) else np.zeros(CLASSES)


def first_model(train: DataFrame, totals: np.ndarray, states: int = STATES, texts: int = SEED_TEXTS) -> Model:
    """Emissions seeded by texts far from each other, out of a small fixed number of texts (by hash of the id); a start only."""
    some = train.orderBy(F.xxhash64("doc_id", "classes")).limit(texts).select("classes").collect()
    seen = [np.bincount(np.frombuffer(r[0], np.uint16), minlength=CLASSES).astype(np.float64) for r in some]
    seen = [c for c in seen if c.sum() >= 30] or seen
    share = (totals + 1e-6) / (totals + 1e-6).sum()
    unit = [np.sqrt(c / c.sum()) for c in seen]
    picked: list[int] = []
    for _ in range(min(states, len(seen))):
        near = [max((float(u @ unit[p]) for p in picked), default=0.0) for u in unit]
        picked.append(int(np.argmin(near)))
    emit = np.empty((CLASSES, states))
    for j in range(states):
        own = seen[picked[j % len(picked)]] if picked else np.zeros(CLASSES)
        shaken = 1.0 + 0.1 * ((tb.constants(CLASSES, 900 + j) >> np.uint64(40)) % np.uint64(1000)).astype(np.float64) / 1000
        mixed = (own + 0.5 * max(own.sum(), 1.0) * share) * shaken
        emit[:, j] = mixed / mixed.sum()
    step = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(step, 0.9 if states > 1 else 1.0)
    even = np.full(states, 1.0 / states)
    return Model(even, even, step, emit)


def train_model(rows: DataFrame, totals: np.ndarray, states: int = STATES, iterations: int = ITERATIONS, segment: int = SEGMENT) -> tuple[Model, list[float]]:
    """Baum-Welch over all training rows; also the log likelihood before each update."""
    train = rows.filter("NOT held_out").select("doc_id", "classes")
    model, path = first_model(train, totals, states), []
    for _ in range(iterations):

        def expect(batches, model=model):
            total = {"emit": np.zeros((CLASSES, states)), "step": np.zeros((states, states)), "start": np.zeros(states), "extra": np.zeros(1)}
            for batch in batches:
                sequences, begins = _segments(batch.column(1).to_pylist(), segment)
                for at in range(0, len(sequences), SIDE_BY_SIDE):
                    counts, likelihood = expected_counts(model, sequences[at : at + SIDE_BY_SIDE], begins[at : at + SIDE_BY_SIDE])
                    for name, value in counts.items():
                        total[name] += value
                    total["extra"] += likelihood
            yield _slots(_packed(total))

        found = _summed(train.mapInArrow(expect, _SLOT_DDL))
        if not len(found):
            break
        cut = np.cumsum([CLASSES * states, states * states, states])
        emit, step, start, extra = np.split(found, cut)
        path.append(float(extra[0]))
        model = normalised({"emit": emit.reshape(CLASSES, states), "step": step.reshape(states, states), "start": start})
    return model, path


def word_emissions(model: Model, totals: np.ndarray, unknown: float) -> np.ndarray:
    """(classes, states): what one word of a class gets, its count in the class left out; unseen words share ``unknown``."""
    emit = model.emit * (1.0 - unknown)
    emit[:WORD_CLASSES] /= np.maximum(totals[:WORD_CLASSES, None], 1.0)
    emit[END] = model.emit[END]
    emit[UNKNOWN] = unknown * (1.0 - model.emit[END])
    return emit


# ---- every word by itself -------------------------------------------------------------------------------------------


class WordModel(NamedTuple):
    model: Model  # emit: (classes, states), the prior
    told: DataFrame  # tile, bucket, shares: of each word of the tile, how its occurrences are dealt to the states
    words: np.ndarray  # (states,): occurrences of all words
    end: np.ndarray  # (states,): probability of the end of a text


def _update(prior: np.ndarray, weight: float):
    """A bucket's words: shares of the tiles added up, the class's share as ``weight`` occurrences; and sums for the driver (tile -1)."""
    states = prior.shape[1]

    def update(asked: pa.Table, sent: pa.Table) -> pa.Table:
        by_tile = dict(zip(sent.column("tile").to_pylist(), sent.column("shares").to_pylist(), strict=True)) if sent.num_rows else {}
        tiles = asked.column("tile").to_pylist()
        keys, sizes = tt.unpacked(asked.column("keys"), np.uint64)
        own, _ = tt.unpacked(asked.column("counts"), np.uint32)
        kinds, _ = tt.unpacked(asked.column("kinds"), np.uint16)
        words, first, place = np.unique(keys, return_index=True, return_inverse=True)
        count = np.bincount(place, weights=own, minlength=len(words))
        total = weight * prior[kinds[first]]
        at = 0
        for tile, size in zip(tiles, sizes, strict=True):
            if tile in by_tile:
                shares = np.frombuffer(by_tile[tile], np.float16).reshape(-1, states)
                total[place[at : at + size]] += own[at : at + size, None] * shares.astype(np.float64)  # a tile has a word once
            at += size
        shares = (total / total.sum(axis=1, keepdims=True)).astype(np.float16)
        answer = shares[place]
        ends = np.append(0, np.cumsum(sizes))
        bucket = (asked if asked.num_rows else sent).column("bucket")[0].as_py()
        rows = [(tile, bucket, tb.pack(answer[ends[k] : ends[k + 1]]), None) for k, tile in enumerate(tiles)]
        rows.append((-1, bucket, None, (count[:, None] * shares.astype(np.float64)).sum(axis=0).tolist()))
        return tt.table(rows, _TOLD)

    return update


def _sums(rows: DataFrame, column: str, size: int) -> np.ndarray:
    found = rows.select(F.posexplode(column).alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(size)
    for k, x in found:
        out[k] = x
    return out


def _own_emissions(told: pa.Table, m: Model, words: np.ndarray, end: np.ndarray, unknown: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """What a tile's words get from every state, their counts in the corpus left out; and (bucket, words) in the order of fingerprints."""
    order = np.argsort(told.column("bucket").to_numpy())
    packed = told.column("shares").to_pylist()
    states = len(m.start)
    buckets = told.column("bucket").to_pylist()
    shares = np.frombuffer(b"".join(packed[k] for k in order), np.float16).reshape(-1, states).astype(np.float64)
    word = shares * ((1.0 - end) * (1.0 - unknown) / np.where(words > 0, words, 1.0))
    return np.concatenate([end[None], unknown * (1.0 - end)[None], word]), [(buckets[k], len(packed[k]) // (2 * states)) for k in order]


def _expect(model: Model, words: np.ndarray, end: np.ndarray, segment: int):
    """A tile's expected counts: the shares of its words to their buckets; end, transitions, starts and likelihood for the driver (bucket -1)."""
    states = len(model.start)

    def expect(texts: pa.Table, told: pa.Table) -> pa.Table:
        if texts.num_rows == 0:
            return _SENT.empty_table()
        emit, sizes = _own_emissions(told, model, words, end, 0.0)
        own = model._replace(emit=emit)
        total, step, start, likelihood = np.zeros(emit.shape), np.zeros((states, states)), np.zeros(states), 0.0
        sequences, begins = _segments(texts.column("words").to_pylist(), segment, np.uint32)
        for at in range(0, len(sequences), SIDE_BY_SIDE):
            counts, more = expected_counts(own, sequences[at : at + SIDE_BY_SIDE], begins[at : at + SIDE_BY_SIDE])
            total += counts["emit"]
            step += counts["step"]
            start += counts["start"]
            likelihood += more
        tile = texts.column("tile")[0].as_py()
        of_words = total[OWN_WORDS:]
        shares = (of_words / np.maximum(of_words.sum(axis=1, keepdims=True), 1e-30)).astype(np.float16)
        rows, at = [], 0
        for bucket, size in sizes:
            rows.append((bucket, tile, tb.pack(shares[at : at + size])))
            at += size
        rows.append((-1, tile, tb.pack(np.concatenate([total[OWN_END], step.reshape(-1), start, [likelihood]]))))
        return tt.table(rows, _SENT)

    return expect


def train_words(corpus: Corpus, model: Model, iterations: int = WORD_ITERATIONS, segment: int = SEGMENT, weight: float = PRIOR) -> tuple[WordModel, list[float]]:
    """Baum-Welch with an emission of its own for every word, from the classes' model; also the log likelihoods (without the
    words' counts, which are constant) before each update."""
    states = len(model.start)
    prior = model.emit * model.overall + 1e-12
    prior /= prior.sum(axis=1, keepdims=True)
    none = corpus.asked.sparkSession.createDataFrame([], _SENT_DDL)

    def updated(sent: DataFrame) -> tuple[DataFrame, np.ndarray]:
        both = corpus.asked.groupBy("bucket").cogroup(sent.groupBy("bucket"))
        told = stage_only(both.applyInArrow(_update(prior, weight), _TOLD_DDL), "hmm-told")
        return told, _sums(told.filter("tile = -1"), "sums", states)

    told, words = updated(none)
    end, path = model.emit[END], []
    train = corpus.rows.filter("NOT held_out").select("tile", "words")
    width = states * states + 2 * states + 1
    for _ in range(iterations if corpus.tokens else 0):
        sent = train.groupBy("tile").cogroup(told.filter("tile >= 0").groupBy("tile")).applyInArrow(_expect(model, words, end, segment), _SENT_DDL)
        sent = stage_only(sent, "hmm-sent")

        def unpack(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([np.frombuffer(x, np.float64).tolist() for x in batch.column(0).to_pylist()], pa.list_(pa.float64()))], names=["sums"])

        sums = _sums(sent.filter("bucket = -1").select("shares").mapInArrow(unpack, "sums array<double>"), "sums", width)
        before = told
        told, words = updated(sent.filter("bucket >= 0"))
        unstage(before)
        unstage(sent)
        ends, step, start, extra = np.split(sums, np.cumsum([states, states * states, states]))
        path.append(float(extra[0]))
        share = corpus.texts / corpus.tokens
        end = (ends + SMOOTHING * share) / (words + ends + SMOOTHING)
        step, start, overall = step.reshape(states, states) + 1.0, start + 1.0, words + ends + 1.0
        model = Model(start / start.sum(), overall / overall.sum(), step / step.sum(axis=1, keepdims=True), model.emit)
    return WordModel(model, told, words, end), path


def log10_likelihood(model: Model, emit: np.ndarray, sequences: list[np.ndarray]) -> np.ndarray:
    """Exact scaled forward recursion over whole sequences, all of a batch side by side."""
    order, active, begin, tokens = side_by_side(sequences)
    total = np.zeros(len(order))
    into, by_state = np.ascontiguousarray(model.step.T), np.ascontiguousarray(emit.T)
    for t, n in enumerate(active):
        before = into @ alpha[:, :n] if t else model.start[:, None]
        alpha = before * by_state[:, tokens[begin[t] : begin[t + 1]]]
        scale = alpha.sum(axis=0)
        total[:n] += np.log10(scale)
        alpha /= scale
    out = np.empty(len(order))
    out[order] = total
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``."""
    corpus = encoded(docs, id_col, text_col)
    totals = class_counts(corpus.rows.filter("NOT held_out"))
    model, _ = train_model(corpus.rows, totals, states, iterations)
    trained, _ = train_words(corpus, model)
    unknown = min(max(corpus.once, 1) / max(corpus.tokens, 1), 0.5) if corpus.tokens else 0.5
    base = math.log10(corpus.tokens + corpus.distinct + 1)
    model, words, end = trained.model, trained.words, trained.end
    facts = ["doc_id", "held_out", "n_tokens", "n_known", "log_next"]

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        emit, _ = _own_emissions(told, model, words, end, unknown)
        own = [np.frombuffer(x, np.uint32) for x in texts.column("words").to_pylist()]
        scores = np.concatenate([log10_likelihood(model, emit, own[at : at + TEXTS_BY_SIDE]) for at in range(0, len(own), TEXTS_BY_SIDE)] or [np.empty(0)])
        return texts.select(facts).append_column("score", pa.array(scores + texts.column("log_count").to_numpy()))

    rows = corpus.rows.select("tile", *facts, "log_count", "words")
    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, log_next double, score double"
    done = rows.groupBy("tile").cogroup(trained.told.filter("tile >= 0").groupBy("tile")).applyInArrow(run, kind)
    return done.select(
        F.nullif("doc_id", F.lit(int(tt.NO_ID))).alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("log_next") - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        "score",
    )
