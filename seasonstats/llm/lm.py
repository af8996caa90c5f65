"""Language-model scores of documents.

The texts are split into words and subwords once and stored so (``_coded``); all later steps read these rows. Word and
subword counts of all training documents are exchanged between buckets of documents (see ``exchange``). The subwords are put into classes of about equal weight, and which class follows which is counted over all training documents.
Beside this table a small causal self-attention model, trained in numpy, predicts the class of the next subword, first its block of classes; within
its class a subword has its share of the counts. The model starts from a sample; then each bucket fits it on to all windows
of its training documents, and the mean of what the buckets change, weighed by their windows, is added. Documents are
scored in overlapping windows, each subword once, with as much context as its window gives, in batches of masked attention.
"""

from __future__ import annotations

import copy
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonstats.llm import exchange as X
from seasonstats.llm.langid import is_held_out
from seasonstats.llm.text import chunks, subwords, word_hashes, words
from seasonstats.llm.tokenfile import with_ends
from seasonstats.sources.shared import materialize

FOLDS = 10
WINDOW, STRIDE = 32, 24  # a later window's first 8 places are context only
CLASSES, WIDTH, OWN = 192, 16, 4096  # OWN: the most frequent subwords have a vector of their own besides their class's
TRAINING_WINDOWS, EPOCHS, BATCH, RATE = 24_576, 2, 256, 0.01  # the bound of the sample that the fit starts from
ON_RATE = 0.003  # of the fit to all windows, which goes on from the sample's
SCORED = 192  # windows at once, so that a batch stays in the processor's cache
FITTED = 128  # windows of a batch at once, likewise
WORDS, SUBWORDS = -1, -2  # names of messages for no bucket
SPACING = np.uint64(1 << 44)  # spreads subword ids over the ranges of hashes
BLOCK = 1024  # numbers of an array that is summed up over tasks, in one row
_BLOCKS = "block int, task int, numbers binary"


_ROOM: dict[str, np.ndarray] = {}


def _room(name: str, *shape: int) -> np.ndarray:
    """Memory that steps of one name use again and again; fresh memory for each costs as much as what is computed in it."""
    size = math.prod(shape)
    if name not in _ROOM or _ROOM[name].size < size:
        _ROOM[name] = np.empty(size, np.float32)
    return _ROOM[name][:size].reshape(shape)


def _taken(rows: np.ndarray, which: np.ndarray, name: str) -> np.ndarray:
    return np.take(rows, which, axis=0, out=_room(name, *which.shape, rows.shape[1]), mode="clip")


class Vocabulary:
    """Classes of subword ids, the last id being the end of a text, and log shares within a class."""

    def __init__(self, counts: np.ndarray, classes: int = CLASSES):
        order = np.argsort(-counts, kind="stable")
        weight = counts[order] + 0.1
        upto = np.cumsum(weight) - weight / 2
        group = np.minimum((upto / weight.sum() * classes).astype(np.int64), classes - 1)
        group = np.unique(group, return_inverse=True)[1]
        self.size = int(group.max()) + 1
        self.group = np.empty(len(counts), np.int32)
        self.group[order] = group
        whole = np.bincount(group, weight, self.size)
        self.share = np.empty(len(counts))
        self.share[order] = np.log(weight / whole[group])
        self.rank = np.empty(len(counts), np.int32)
        self.rank[order] = np.arange(len(counts))


class Attention:
    """One causal attention layer beside a table of class pairs, which is fitted too unless ``pairs`` counts them.

    The next class is predicted in two steps, its block of about the root of all classes, then the class within the block, so
    that a place costs two short rows of numbers instead of one for every class. Nothing is left out: the steps multiply to
    the probability of the class, and the pairs' counts give the same shares as in one step.
    """

    def __init__(
        self, vocabulary: Vocabulary, width: int = WIDTH, own: int = OWN, seed: int = 5, pairs: np.ndarray | None = None
    ):
        draw, c = np.random.default_rng(seed), vocabulary.size
        self.v, self.own = vocabulary, min(own, len(vocabulary.group))
        self.each = math.isqrt(c - 1) + 1  # classes a block
        self.blocks = -(-c // self.each)
        # Rows of the table of vectors: the most frequent subwords, then the classes of all others.
        self.key = np.where(vocabulary.rank < self.own, vocabulary.rank, self.own + vocabulary.group).astype(np.int32)
        self.of_key = np.concatenate([vocabulary.group[np.argsort(vocabulary.rank)][: self.own], np.arange(c)])
        spread = self.blocks * self.each
        make = lambda *shape: (draw.standard_normal(shape) * 0.1).astype(np.float32)
        self.w = {
            "own": np.zeros((self.own, width), np.float32), "group": make(c, width), "place": make(WINDOW, width),
            "qkv": make(width, 3 * width), "back": make(width, width), "out": make(width, spread), "top": make(width, self.blocks),
            "tops": np.zeros((c, self.blocks), np.float32), "pairs": np.full((c, spread), -60, np.float32),
        }
        self.w["pairs"][:, :c] = 0  # what fills up the last block has no weight
        self.fitted = [name for name in self.w if name not in ("tops", "pairs") or pairs is None]
        if pairs is not None:
            share = (pairs.sum(axis=0) + 0.1) / (pairs.sum() + 0.1 * c)
            chance = (pairs + c * share) / (pairs.sum(axis=1, keepdims=True) + c)
            whole = np.add.reduceat(chance, np.arange(0, c, self.each), axis=1)
            self.w["tops"] = np.log(whole).astype(np.float32)
            self.w["pairs"][:, :c] = np.log(chance / np.repeat(whole, self.each, axis=1)[:, :c])
        self.seen = np.tril(np.ones((WINDOW, WINDOW), np.float32))  # places to come are masked

    def _table(self) -> np.ndarray:
        """The vectors of all keys: a class's, and a frequent subword's own added to it."""
        table = self.w["group"][self.of_key]
        table[: self.own] += self.w["own"]
        return table

    def _scaled(self) -> np.ndarray:
        """The weights of questions, keys and values, the questions' by the root of the width."""
        scaled, width = self.w["qkv"].copy(), self.w["back"].shape[0]
        scaled[:, :width] *= np.float32(width**-0.5)
        return scaled

    def _hidden(self, keys: np.ndarray, table: np.ndarray, scaled: np.ndarray) -> tuple[np.ndarray, tuple]:
        """What each place of the windows ``keys`` knows of itself and the places before it."""
        w, width, t = self.w, self.w["back"].shape[0], keys.shape[1]
        x = _taken(table, keys, "x")
        x += w["place"][:t]
        # Whole matrices: numpy multiplies a stack of small ones one by one.
        flat = x.reshape(-1, width)
        qkv = np.matmul(flat, scaled, out=_room("qkv", len(flat), 3 * width)).reshape(len(x), t, 3 * width)
        q, k, v = qkv[:, :, :width], qkv[:, :, width : 2 * width], qkv[:, :, 2 * width :]
        a = np.matmul(q, k.transpose(0, 2, 1), out=_room("a", len(x), t, t))
        if len(a) and max(a.max(), -a.min()) > 60:
            np.clip(a, -60, 60, out=a)
        np.exp(a, out=a)
        a *= self.seen[:t, :t]
        total = (a.reshape(-1, t) @ np.ones(t, np.float32)).reshape(len(x), t, 1)
        z = np.matmul(a, v, out=_room("z", *x.shape))
        z /= total
        h = np.matmul(z.reshape(-1, width), w["back"], out=_room("h", *flat.shape))
        h += flat
        return h.reshape(x.shape), (x, q, k, v, a, z, total)

    def _logits(self, hidden: np.ndarray, group: np.ndarray, block: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of all blocks, and of the classes in each place's ``block``. Places are in order of blocks, which start ``at``."""
        w = self.w
        top = _taken(w["tops"], group, "top")
        top += np.matmul(hidden, w["top"], out=_room("step", *top.shape))
        inside = _taken(w["pairs"].reshape(-1, self.each), group * self.blocks + block, "inside")
        for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
            if b > a:
                inside[a:b] += hidden[a:b] @ w["out"][:, i * self.each : (i + 1) * self.each]
        for logits in (top, inside):
            if len(logits) and logits.max() > 60:
                np.clip(logits, -60, 60, out=logits)
        return top, inside

    def _by_block(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order of the places by their class's block, these blocks, where each block starts and the last ends)."""
        block = target // self.each
        order = np.argsort(block.astype(np.int16), kind="stable")
        block = block[order]
        return order, block, np.searchsorted(block, np.arange(self.blocks + 1)).tolist()

    def gradients(self, ids: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of the windows and its gradient, a few windows at a time, so that what is between stays in the cache."""
        g = {k: np.zeros_like(self.w[k]) for k in self.fitted}
        keys, group, table, scaled = self.key[ids], self.v.group[ids], self._table(), self._scaled()
        width = table.shape[1]
        loss, dx = 0.0, _room("dx", width, keys.size)
        for i in range(0, len(ids), FITTED):
            part = slice(i, i + FITTED)
            more, d = self._add_gradients(keys[part], group[part], target[part], target.size, g, table, scaled)
            loss += more
            dx[:, i * ids.shape[1] : i * ids.shape[1] + len(d)] = d.T
        g["qkv"][:, :width] *= np.float32(width**-0.5)
        # A frequent subword's vector belongs to one class, so that the classes' sums are made from the keys'.
        keys = keys.ravel()
        sums = np.stack([np.bincount(keys, d, len(self.of_key)) for d in dx])
        g["own"][:] = sums[:, : self.own].T
        g["group"][:] = sums[:, self.own :].T
        if self.own:
            head = np.flatnonzero(np.diff(self.of_key[: self.own], prepend=-1))
            g["group"][self.of_key[head]] += np.add.reduceat(sums[:, : self.own], head, axis=1).T
        return loss, g

    def _add_gradients(
        self, keys: np.ndarray, group: np.ndarray, target: np.ndarray, n: int, g: dict[str, np.ndarray], table: np.ndarray,
        scaled: np.ndarray,
    ) -> tuple[float, np.ndarray]:
        """(loss, gradient of the vectors of places) of these windows of a batch of ``n`` places; the rest is added to ``g``."""
        w, width = self.w, self.w["back"].shape[0]
        h, (x, q, k, v, a, z, total) = self._hidden(keys, table, scaled)
        flat = lambda m: m.reshape(-1, m.shape[-1])
        loss, dh = self._add_classes(flat(h), group.ravel(), target.ravel(), n, g)
        g["back"] += flat(z).T @ dh
        dz = np.matmul(dh, w["back"].T, out=_room("dz", *dh.shape)).reshape(z.shape)
        dz /= total
        dqkv = _room("dqkv", *z.shape[:2], 3 * width)
        np.matmul(a.transpose(0, 2, 1), dz, out=dqkv[:, :, 2 * width :])
        ds = np.matmul(dz, v.transpose(0, 2, 1), out=_room("ds", *a.shape))
        # The sum of a place's attention times what it is wanted to be is what it has read times how that is wanted.
        ds -= np.einsum("ijk,ijk->ij", dz, z)[:, :, None]
        ds *= a
        np.matmul(ds, k, out=dqkv[:, :, :width])
        np.matmul(ds.transpose(0, 2, 1), q, out=dqkv[:, :, width : 2 * width])
        g["qkv"] += flat(x).T @ flat(dqkv)
        dh += np.matmul(flat(dqkv), scaled.T, out=_room("step", *dh.shape))
        g["place"][: x.shape[1]] += dh.reshape(x.shape).sum(axis=0)
        return loss, dh

    def _add_classes(
        self, hidden: np.ndarray, group: np.ndarray, target: np.ndarray, n: int, g: dict[str, np.ndarray]
    ) -> tuple[float, np.ndarray]:
        """(loss, gradient of ``hidden``) of the two steps to the class of each place."""
        w = self.w
        order, block, at = self._by_block(target)
        h, group, inner = _taken(hidden, order, "ordered"), group[order], target[order] - block * self.each
        top, inside = self._logits(h, group, block, at)
        loss, rows = 0.0, np.arange(len(h))
        for d, wanted in ((top, block), (inside, inner)):
            np.exp(d, out=d)
            total = d @ np.ones(d.shape[1], np.float32)
            loss += float(np.log(total / d[rows, wanted]).sum()) / n
            d *= (1 / (total * np.float32(n)))[:, None]
            d[rows, wanted] -= np.float32(1 / n)
        g["top"] += h.T @ top
        if "pairs" in self.fitted:
            np.add.at(g["tops"], group, top)
            np.add.at(g["pairs"].reshape(-1, self.each), group * self.blocks + block, inside)
        dh = np.matmul(top, w["top"].T, out=_room("step", *h.shape))
        for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
            if b > a:
                classes = slice(i * self.each, (i + 1) * self.each)
                g["out"][:, classes] += h[a:b].T @ inside[a:b]
                dh[a:b] += inside[a:b] @ w["out"][:, classes].T
        back = _room("dh", *dh.shape)
        back[order] = dh
        return loss, back

    def fit(self, windows: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE) -> list[float]:
        """Adam over ``windows`` of WINDOW + 1 ids; the loss of each step."""
        first = {k: np.zeros_like(self.w[k]) for k in self.fitted}
        second = {k: np.zeros_like(self.w[k]) for k in self.fitted}
        draw, losses = np.random.default_rng(11), []
        steps = max(1, epochs * -(-len(windows) // batch)) if len(windows) else 0
        order = np.concatenate([draw.permutation(len(windows)) for _ in range(epochs)]) if steps else []
        for step in range(steps):
            part = windows[order[step * batch : (step + 1) * batch]]
            if not len(part):
                break
            loss, grads = self.gradients(part[:, :-1], self.v.group[part[:, 1:]])
            losses.append(loss)
            pace = rate * (1 - step / steps)
            for name, g in grads.items():
                m, s = first[name], second[name]
                root = np.multiply(g, g, out=_room("step", *g.shape))
                root *= np.float32(0.01)
                s *= np.float32(0.99)
                s += root
                m *= np.float32(0.9)
                g *= np.float32(0.1)
                m += g
                np.multiply(s, np.float32(1 / (1 - 0.99 ** (step + 1))), out=root)
                np.sqrt(root, out=root)
                root += np.float32(1e-7)
                np.divide(m, root, out=root)
                root *= np.float32(pace / (1 - 0.9 ** (step + 1)))
                self.w[name] -= root
        return losses

    def flat(self) -> np.ndarray:
        """All fitted weights in a row."""
        return np.concatenate([self.w[k].ravel() for k in self.fitted]).astype(np.float64)

    def moved(self, change: np.ndarray) -> Attention:
        """A copy with ``change`` added to the fitted weights."""
        other, at = copy.copy(self), 0
        other.w = dict(self.w)
        for k in self.fitted:
            m = self.w[k]
            other.w[k] = m + change[at : at + m.size].reshape(m.shape).astype(np.float32)
            at += m.size
        return other

    def score(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log10 probability of each text; ``ids`` hold an end after every text."""
        end = len(self.v.group) - 1
        lengths = np.diff(offsets)
        total = np.zeros(len(lengths))
        # What stands before a text is an end; every place of a text is a target once.
        before = np.concatenate([[end], ids[:-1]])
        before[offsets[:-1][lengths > 0]] = end
        counts = 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE))
        owner = np.repeat(np.arange(len(lengths)), counts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = offsets[:-1][owner] + number * STRIDE
        place = np.arange(WINDOW)
        keys, group, table, scaled = self.key[before], self.v.group[before], self._table(), self._scaled()
        wanted, share = self.v.group[ids], self.v.share[ids]
        for a in range(0, len(owner), SCORED):
            own = owner[a : a + SCORED]
            at = begin[a : a + SCORED, None] + place
            inside = at < offsets[1:][own, None]
            scored = inside & ((place >= WINDOW - STRIDE) | (number[a : a + SCORED, None] == 0))
            hidden, _ = self._hidden(keys[np.where(inside, at, 0)], table, scaled)
            # Only the places that are scored go on to the classes.
            which = np.flatnonzero(scored)
            at = at.ravel()[which]
            order, block, starts = self._by_block(wanted[at])
            which, at = which[order], at[order]
            logits = self._logits(_taken(hidden.reshape(-1, hidden.shape[2]), which, "ordered"), group[at], block, starts)
            value, rows = share[at], np.arange(len(at))
            for out, to in zip(logits, (block, wanted[at] - block * self.each), strict=True):
                value += out[rows, to]
                value -= np.log(np.exp(out, out=out) @ np.ones(out.shape[1], np.float32))
            total += np.bincount(own[which // WINDOW], value, len(total))
        return total / np.log(10)


def _lowered(part: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of the texts with A-Z in lower case, distinct again. The tokenizer reads lower case too."""
    known, codes, offsets = words(part.column("text"))
    low = pc.ascii_lower(known).dictionary_encode()
    return low.dictionary, low.indices.to_numpy()[codes], offsets


CODED_BYTES = 16 << 20  # of text in a row, so that a bucket of a small input is one row
_CODED = (
    "bucket int, doc_ids array<long>, learn array<boolean>, starts binary, codes binary, hashes binary, counts binary, "
    "ends binary, pieces binary"
)
# Rows of some megabytes: groups of rows are closed by size, not only after a hundred rows.
_LARGE_ROWS = {
    "compression": "zstd", "parquet.block.size": str(32 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1",
}


def _coded(docs: DataFrame, path: str) -> DataFrame:
    """The documents of each bucket in words and subwords, a row for some megabytes of text: where each one's words start,
    the number of each word in a list, and this list's hashes, training counts and subwords. Every later step reads these."""
    dealt = docs if "bucket" in docs.columns else X.deal(docs, X.bucket_count(docs), "doc_id", "text", F.col("learn"))

    def coded(key, table):
        # In order of ids, so that the fit does not depend on how the shuffle arrives.
        table = table.select(["doc_id", "text", "learn"]).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        rows = []
        for part in chunks(table, size=CODED_BYTES):
            known, codes, offsets = _lowered(part)
            learn = part.column("learn")
            learnt = np.repeat(learn.to_numpy(zero_copy_only=False).astype(bool), np.diff(offsets))
            lists = subwords(path).encode_words(known)
            ends = lists.offsets.to_numpy()
            numbers = [
                (offsets, np.int64), (codes, np.int32), (word_hashes(known), np.uint64),
                (np.bincount(codes[learnt], minlength=len(known)), np.int64), (ends - ends[0], np.int32),
                (lists.values.to_numpy()[ends[0] : ends[-1]], np.int32),
            ]
            ids = part.column("doc_id").cast(pa.int64()).to_pylist()
            rows.append((key[0].as_py(), ids, learn.to_pylist(), *(X.packed(v.astype(kind)) for v, kind in numbers)))
        kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 6]
        columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in _CODED.split(", ")])

    return dealt.groupBy("bucket").applyInArrow(coded, _CODED)


_KINDS = {
    "starts": np.int64, "codes": np.int32, "hashes": np.uint64, "counts": np.int64, "ends": np.int32, "pieces": np.int32,
}


def _rows(batches) -> Iterator[dict]:
    """Rows of ``_coded``, or of some of its columns, with arrays of numbers."""
    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            row = {c: batch.column(names.index(c))[i] for c in names}
            yield {c: X.unpacked(v.as_py(), _KINDS[c]) if c in _KINDS else v for c, v in row.items()}


def _buckets(batches) -> Iterator[tuple[int, Iterator[dict]]]:
    """(bucket, its rows), as rows of a bucket are stored one after the other."""
    return itertools.groupby(_rows(batches), lambda row: row["bucket"].as_py())


def _ids(row: dict, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(subwords of all texts of a row with ends, where each text's start and the last end)."""
    lists = pa.ListArray.from_arrays(pa.array(row["ends"]), pa.array(row["pieces"])).take(pa.array(row["codes"]))
    return with_ends(lists.values.to_numpy(), lists.offsets.to_numpy().astype(np.int64)[row["starts"]], end)


def _learnt_ids(row: dict, end: int) -> np.ndarray:
    """Subwords of the training texts of a row, with ends."""
    ids, offsets = _ids(row, end)
    return ids[np.repeat(row["learn"].values.to_numpy(zero_copy_only=False).astype(bool), np.diff(offsets))]


def _counted(bucket: int, rows: Iterator[dict]) -> list:
    """Training counts of a bucket's words and subwords; words that only others have are asked for with 0."""
    rows = list(rows)
    hashes, place = np.unique(np.concatenate([r["hashes"] for r in rows]), return_inverse=True)
    counts = np.concatenate([r["counts"] for r in rows])
    pieces = np.concatenate([r["pieces"] for r in rows])
    weights = np.concatenate([np.repeat(r["counts"], np.diff(r["ends"])) for r in rows])
    sums = np.bincount(pieces, weights) if len(pieces) else np.zeros(0)
    used = np.flatnonzero(sums)
    return [
        (bucket, hashes, np.bincount(place, counts, len(hashes)).astype(np.int64)),
        (SUBWORDS, used.astype(np.uint64) * SPACING, sums[used].astype(np.int64)),
    ]


def _summed(messages: list[X.Message]):
    """Each bucket's words with their counts, how many words there are and how often they occur, and subword counts."""
    asked = [m for m in messages if m.bucket >= 0]
    if asked:
        every, at = np.unique(np.concatenate([m.hashes for m in asked]), return_index=True)
        sums = np.zeros(len(every), np.int64)
        for m in asked:
            np.add.at(sums, np.searchsorted(every, m.hashes), m.extra)
        del at
        for m in asked:
            own = sums[np.searchsorted(every, m.hashes)]
            yield m.bucket, m.hashes[own > 0], own[own > 0]
        yield WORDS, np.array([(sums > 0).sum()], np.uint64), np.array([sums.sum()])
    pieces = [m for m in messages if m.bucket == SUBWORDS]
    if pieces:
        ids = np.concatenate([m.hashes for m in pieces])
        every, place = np.unique(ids, return_inverse=True)
        yield SUBWORDS, every, np.bincount(place, np.concatenate([m.extra for m in pieces])).astype(np.int64)


def _blocks(numbers: np.ndarray, task: int) -> pa.Table:
    """``numbers`` as rows of ``_BLOCKS``."""
    parts = [numbers[a : a + BLOCK].tobytes() for a in range(0, len(numbers), BLOCK)]
    return pa.table({
        "block": pa.array(range(len(parts)), pa.int32()), "task": pa.array([task] * len(parts), pa.int32()),
        "numbers": pa.array(parts, pa.binary()),
    })


def _added_up(rows: DataFrame, kind: type) -> np.ndarray:
    """The sum, in the order of tasks, of the arrays that ``rows`` hold in blocks; as long as one of them."""

    def added(key, table):
        table = table.sort_by("task")
        total = sum(np.frombuffer(x, kind) for x in table.column("numbers").to_pylist())
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "task": pa.array([0], pa.int32()),
                         "numbers": pa.array([total.tobytes()], pa.binary())})

    # One array, whose length the classes and the width of the model bound.
    found = sorted(rows.groupBy("block").applyInArrow(added, _BLOCKS).collect())
    return np.concatenate([np.frombuffer(r["numbers"], kind) for r in found]) if found else np.zeros(0, kind)


def _windows(ids: np.ndarray, end: int) -> np.ndarray:
    """``ids`` in windows of WINDOW + 1, an end before the first; the last one reaches back, or has more ends before it."""
    if not len(ids):
        return np.zeros((0, WINDOW + 1), np.int32)
    ids = np.concatenate([np.full(max(1, WINDOW + 1 - len(ids)), end), ids])
    begin = np.arange(0, len(ids) - 1, WINDOW)
    return ids[np.minimum(begin, len(ids) - WINDOW - 1)[:, None] + np.arange(WINDOW + 1)].astype(np.int32)


def _pair_counts(docs: DataFrame, path: str, vocabulary: Vocabulary, end: int) -> np.ndarray:
    """How often each class follows each, over all training documents. These may be ``_coded`` already, as below."""
    c, group = vocabulary.size, vocabulary.group

    def counted(batches):
        total = np.zeros(c * c, np.int64)
        for row in _rows(batches):
            of = group[np.concatenate([[end], _learnt_ids(row, end)])]
            total += np.bincount(of[:-1] * c + of[1:], minlength=c * c)
        if total.any():
            yield from _blocks(total, 0).to_batches()

    coded = docs if "codes" in docs.columns else _coded(docs, path)
    found = _added_up(coded.select("learn", "starts", "codes", "ends", "pieces").mapInArrow(counted, _BLOCKS), np.int64)
    return (found if len(found) else np.zeros(c * c, np.int64)).reshape(c, c)


def _fitted_on(dealt: DataFrame, path: str, model: Attention, end: int) -> Attention:
    """``model`` fitted on to the windows of all training documents, bucket by bucket, and the changes' weighed mean."""

    def changed(batches):
        for bucket, rows in _buckets(batches):
            own, windows = model.moved(np.zeros(len(model.flat()))), 0
            for row in rows:
                found = _windows(_learnt_ids(row, end), end)
                own.fit(found, epochs=1, rate=ON_RATE)
                windows += len(found)
            yield from _blocks(np.concatenate([(own.flat() - model.flat()) * windows, [windows]]), bucket).to_batches()

    coded = dealt if "codes" in dealt.columns else _coded(dealt, path)
    rows = coded.select("bucket", "learn", "starts", "codes", "ends", "pieces")
    total = _added_up(rows.mapInArrow(changed, _BLOCKS), np.float64)
    return model.moved(total[:-1] / total[-1]) if len(total) and total[-1] else model


def _training_windows(docs: DataFrame, path: str, words_learnt: int, end: int) -> np.ndarray:
    """Windows of whole training documents drawn by the hash of id and text, about TRAINING_WINDOWS of them. The fit
    starts from these; ``_fitted_on`` takes it to all others."""
    # A word has some two subwords or more.
    part = min(1.0, TRAINING_WINDOWS * WINDOW / max(1, 2 * words_learnt))
    drawn = docs.where("learn").where(F.pmod(F.xxhash64(F.lit(3), "doc_id", "text"), F.lit(1 << 20)) < int(part * (1 << 20)) + 1)

    def cut(batches):
        for batch in batches:
            for rows in chunks(batch):
                ids, offsets = with_ends(*subwords(path).encode(rows.column("text")), end)
                yield pa.RecordBatch.from_arrays([pa.array([_windows(ids, end).tobytes()], pa.binary())], ["windows"])

    rows = drawn.select("doc_id", "text").mapInArrow(cut, "windows binary").collect()
    found = [np.frombuffer(r["windows"], np.int32).reshape(-1, WINDOW + 1) for r in rows]
    return np.concatenate(found) if found else np.zeros((0, WINDOW + 1), np.int32)


def score_documents(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", folds: int = FOLDS, fold: int = 0
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    Tokens are words, A-Z in lower case, and one end for each text. Null text is empty: its end alone. Documents whose id
    leaves ``fold`` in its checksum are held out of all counts and of the model's fit; a null id is learnt from. Rows
    are scored each for itself, repeated or not. With no training documents all counts are 0 and the model is as drawn.
    Words are told apart by hashes of 64 bits. Other columns are not read.
    """
    held = is_held_out(F.col(id_column), folds, fold)
    buckets = X.bucket_count(docs, text_column)
    dealt = X.deal(docs, buckets, id_column, text_column, (~held).alias("learn"))

    coded = materialize(_coded(dealt, path), "coded", **_LARGE_ROWS)

    def counted(batches):
        for bucket, rows in _buckets(batches):
            yield from X.cut(bucket, _counted(bucket, rows), buckets, np.int64).to_batches()

    messages = coded.select("bucket", "hashes", "counts", "ends", "pieces").mapInArrow(counted, X.MESSAGE)
    replies = materialize(X.answer(messages, _summed, np.int64, np.int64), "word_counts")
    # One row for each range of hashes, and a count for each subword of the tokenizer.
    told = replies.where(F.col("bucket") < 0).select("bucket", "hashes", "extra").collect()
    totals = [(r["bucket"], X.unpacked(r["hashes"], np.uint64), X.unpacked(r["extra"], np.int64)) for r in told]
    ends = docs.where(~held).count()
    distinct = sum(int(h[0]) for name, h, _ in totals if name == WORDS) + (ends > 0)
    train_tokens = sum(int(e[0]) for name, _, e in totals if name == WORDS) + ends
    end = subwords(path).tokenizer.get_vocab_size()
    pieces = np.zeros(end + 1)
    pieces[end] = ends
    for name, ids, counts in totals:
        if name == SUBWORDS:
            pieces[(ids // SPACING).astype(np.int64)] = counts
    vocabulary = Vocabulary(pieces)
    known_ids = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), (~held).alias("learn"))
    started = Attention(vocabulary, pairs=_pair_counts(coded, path, vocabulary, end))
    started.fit(_training_windows(known_ids, path, train_tokens, end))
    model = _fitted_on(coded, path, started, end)
    whole = float(np.log10(train_tokens + 0.1 * (distinct + 1)))
    end_score = float(np.log10(ends + 0.1))

    def scored(_, table, said):
        hashes, counts = X.gathered(said, np.int64)
        out = []
        for row in _rows(table.to_batches()):
            found, at = X.found_at(row["hashes"], hashes)
            count = np.where(found, counts[at] if len(counts) else 0, 0)[row["codes"]]
            upto = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[row["starts"]])  # noqa: B023, E731
            n = np.diff(row["starts"]) + 1
            base = upto(np.log10(count + 0.1)) + end_score - n * whole
            score = model.score(*_ids(row, end))
            learn = row["learn"].values.to_numpy(zero_copy_only=False).astype(bool)
            columns = [
                row["doc_ids"].values, pa.array(~learn), pa.array(n), pa.array(upto(count > 0) + (ends > 0)),
                pa.array(np.full(len(n), train_tokens)), pa.array(base), pa.array(score),
            ]
            out.append(pa.RecordBatch.from_arrays(columns, names))
        return pa.Table.from_batches(out, kinds)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    kinds = pa.schema(list(zip(names, [pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2], strict=True)))
    rows = coded.drop("counts").repartition(buckets, "bucket")
    return X.with_their_replies(rows, replies.where(F.col("bucket") >= 0), buckets).applyInArrow(scored, schema)
