"""Toxicity by a subsequence string-kernel SVM with Nystrom landmarks.

The kernel counts common subsequences of four characters in which up to two characters may be skipped
between neighbours, each skip weighing ``DECAY``: "idiot" and "id-iot" share most of theirs. '!', '?', ';' and newline
end a sentence only before white space or the text's end, so inside a word they don't. All marks between two bytes of
words and all characters without width are taken out before, in training too, so any number of them hides nothing.
What is spread evenly by white space, newlines or letters is found by reading the text at every second and every third
byte, too: there it stands as a plain word. The kernel compares windows of a sentence with landmark windows. Landmarks
come from labelled sentences, half of them where characteristic subsequences of toxic documents meet. Windows of the
training sentences are mapped by the landmarks (k(x) K^-1/2) and a linear SVM is fitted there; a
toxic document only says that one of its windows is toxic, so its best window is chosen anew in each
round while all windows of clean documents stay negative. After the first round up to ``ALTERED`` of those windows are
learnt once more with a letter put in after every third character and among bytes of clean texts, together as heavy as
``SHARE`` of the toxic documents. A text's score is the best window of all its sentences and readings,
through a logistic curve.

A decision value is a sum over landmarks of coefficient times kernel, and the kernel a sum over
subsequences, so it folds into one weight per subsequence (hashed to ``TABLE`` places, training
included): each character position is scored by 27 look-ups a reading, whatever the number of landmarks.

Training reads at most ``max_docs`` labelled documents per class, of ``max_doc_bytes`` at most,
picked by a hash of the id. Every text is scored in full.

Defined cases: null and empty text, or no labels of both classes, have score 0 (without labels of
both classes: 0 for all); labels that are null or repeated with both values are not learnt from; repeated rows are
scored alike, whatever their ids, which may be null; texts of any length are scored whole; columns of any
other name stay, those of the result's names are replaced; an empty table gives an empty result. Landmark windows
and training windows have unit norm; a scored window isn't divided by its own, which the logistic curve is fitted to.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import LOWER, SPACE, chunks, segment_max, text_bytes
from tallyforge.llm.shared import fewer_rows, saved

MAX_DOCS, MAX_DOC_BYTES = 1500, 1 << 15
WINDOW, DECAY, TABLE, LANDMARKS, ROUNDS, ALTERED, SHARE = 8, 0.8, 1 << 18, 512, 4, 300, 0.5
STEPS = [(a, b, c) for a in (1, 2, 3) for b in (1, 2, 3) for c in (1, 2, 3)]
REACH = 9
#: A text is also read at every second and every third byte: "i d i o t" and "ixdxixoxt" spell what they hide.
STRIDES = (1, 2, 3)
#: Bytes that end a sentence where white space or the text's end follows; no subsequence crosses such an end.
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in "\n!?;"]] = True
#: Bytes that are neither part of a word nor white space.
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
MARK = ~WORD & ~SPACE


def unseen(data: np.ndarray) -> np.ndarray:
    """Bytes of characters without width: U+200B to U+200F, U+2060 and U+FEFF."""
    out = np.zeros(len(data), bool)
    if len(data) > 2:
        a, b, c = data[:-2], data[1:-1], data[2:]
        at = np.flatnonzero((a == 0xE2) & ((b == 0x80) & (c >= 0x8B) & (c <= 0x8F) | (b == 0x81) & (c == 0xA0)) | (a == 0xEF) & (b == 0xBB) & (c == 0xBF))
        out[at] = out[at + 1] = out[at + 2] = True
    return out


def altered(rng: np.random.Generator, text: bytes) -> list[bytes]:
    """A stretch with a letter put in after every third character, beginning at each of three."""
    letter = bytes([int(rng.integers(97, 123))])
    return [letter.join(text[i : i + 3] for i in range(k - 3, len(text), 3) if i > -3) for k in (1, 2, 3)]


def amid(rng: np.random.Generator, text: np.ndarray, before: bytes, after: bytes) -> list[bytes]:
    """A stretch among other bytes, as it is and with letters for its white space, as a spread word is read."""
    letters = np.where(SPACE[text], rng.integers(97, 123, len(text)).astype(np.uint8), text)
    return [before + text.tobytes() + after, before + letters.tobytes() + after]


def strided(data: np.ndarray, offsets: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text as ``stride`` texts: every stride-th byte, from the first, the second and so on."""
    size = np.diff(offsets)
    cuts = np.concatenate([[0], np.cumsum((size[:, None] - np.arange(stride) + stride - 1).ravel() // stride)])
    text = np.repeat(np.arange(len(size)), size)
    turn, lane = np.divmod(np.arange(len(data)) - offsets[text], stride)
    out = np.empty_like(data)
    out[cuts[text * stride + lane] + turn] = data
    return out, cuts


def joined(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts without the marks put between two bytes of words: "i--d!iot" becomes "idiot"."""
    odd = MARK[data] | unseen(data)
    mark, other = np.flatnonzero(odd), np.flatnonzero(~odd)
    after = np.searchsorted(other, mark)
    mark, after = mark[inner := (after > 0) & (after < len(other))], after[inner]
    left, right = other[after - 1], other[after]
    same = np.searchsorted(offsets, left, side="right") == np.searchsorted(offsets, right, side="right")
    keep = np.ones(len(data), bool)
    keep[mark[same & WORD[data[left]] & WORD[data[right]]]] = False
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def prepared(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes and the number of each one's sentence, with room to look ahead."""
    followed = np.ones(len(data), bool)
    followed[:-1] = SPACE[data[1:]]
    followed[offsets[1:][np.diff(offsets) > 0] - 1] = True
    block = np.cumsum(ENDS[data] & followed, dtype=np.int32)
    block += np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets)) * 2
    return np.concatenate([LOWER[data], np.zeros(REACH, np.uint8)]), np.concatenate([block, np.full(REACH, -1, np.int32)])


def subsequences(x: np.ndarray, block: np.ndarray):
    """For each of the 27 gap patterns: (place in the table per position, weight, valid positions)."""
    n = x.shape[-1] - REACH
    for a, b, c in STEPS:
        i, j, k = a, a + b, a + b + c
        key = x[..., k : n + k].astype(np.uint32)
        for part in (x[..., j : n + j], x[..., i : n + i], x[..., :n]):
            key = key << np.uint32(8) | part
        place = (key * np.uint32(2654435761)) >> np.uint32(14)
        yield place, DECAY ** (k - 3), block[..., k : n + k] == block[..., :n]


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def positions(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The weights of the subsequences that begin at each byte: as ``subsequences`` gives them, but with shared beginnings of keys."""
        x, block = prepared(data, offsets)
        n = len(data)
        first = x.astype(np.uint32)
        second, third, fourth = first << np.uint32(8), first << np.uint32(16), first << np.uint32(24)
        sums = {k: np.zeros(n, np.float32) for k in range(3, REACH + 1)}
        for a in (1, 2, 3):
            two = first[:n] | second[a : n + a]
            for b in (1, 2, 3):
                three = two | third[a + b : n + a + b]
                for c in (1, 2, 3):
                    k = a + b + c
                    key = three | fourth[k : n + k]
                    key *= np.uint32(2654435761)
                    key >>= np.uint32(14)
                    sums[k] += self.weights.take(key.astype(np.intp), mode="clip")  # no place is outside; this spares the test
        out = np.zeros(n, np.float32)
        for k, found in sums.items():
            out += found * (np.float32(DECAY ** (k - 3)) * (block[k : n + k] == block[:n]))
        return out

    def best(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The best window of each text, read as it is and at each of STRIDES."""
        out = np.full(len(offsets) - 1, -np.inf)
        for stride in STRIDES:
            own, cuts = strided(data, offsets, stride) if stride > 1 else (data, offsets)
            top = segment_max(window_sums(self.positions(own, cuts), cuts), cuts, -np.inf)
            out = np.maximum(out, top.reshape(-1, stride).max(axis=1))
        return out + self.bias

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        data, offsets = joined(data, offsets)
        z = np.clip(self.slope * self.best(data, offsets) + self.shift, -60, 60)
        return np.where(np.diff(offsets) > 0, 1 / (1 + np.exp(-z)), 0.0)


def window_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum over the window from each position, cut at its text's end."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    end = np.minimum(np.arange(len(values)) + WINDOW, np.repeat(offsets[1:], np.diff(offsets)))
    return total[end] - total[: len(values)]


def window_features(x: np.ndarray, block: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, weights), one row per window: its subsequences; weight 0 for what it lacks."""
    at = np.minimum(starts[:, None] + np.arange(WINDOW + REACH), len(x) - 1)
    inside = at[:, :WINDOW] < offsets[np.searchsorted(offsets, starts, side="right")][:, None]
    found = [(place, np.where(inside & valid, np.float32(weight), np.float32(0))) for place, weight, valid in subsequences(x[at], block[at])]
    places, weights = (np.concatenate(part, axis=1) for part in zip(*found, strict=True))
    return places, weights / np.maximum(np.sqrt((weights**2).sum(axis=1, keepdims=True)), 1e-9).astype(np.float32)


def best_starts(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the best window of each text begins; empty texts are left out."""
    sums = window_sums(model.positions(data, offsets), offsets)
    return np.array([a + int(sums[a:b].argmax()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) if b > a], np.int64)


def drawn_places(rng: np.random.Generator, offsets: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """``n`` places drawn from all bytes of ``docs`` alike, so that a text counts by its length."""
    end = np.cumsum(np.diff(offsets)[docs])
    at = rng.integers(0, end[-1], n)
    of = np.searchsorted(end, at, side="right")
    return offsets[docs[of] + 1] - end[of] + at


def fit(texts: list[str], toxic: np.ndarray, seed: int = 11) -> Model | None:
    """A model from labelled texts; None without both classes."""
    toxic = np.asarray(toxic, bool)
    if toxic.all() or not toxic.any():
        return None
    rng = np.random.default_rng(seed)
    data, offsets = joined(*text_bytes(pa.array(texts, pa.large_string())))
    x, block = prepared(data, offsets)
    # Documents of each class that hold a gapless subsequence; its log odds point to telling windows.
    pos, neg = np.zeros(TABLE), np.zeros(TABLE)
    for i, j, part, own in chunks(data, offsets):
        place, _, valid = next(subsequences(*prepared(part, own)))
        doc = np.repeat(np.arange(i, j, dtype=np.int64), np.diff(own))
        pairs = np.unique(doc[valid] * TABLE + place[valid])
        of, place = toxic[pairs // TABLE], pairs % TABLE
        pos += np.bincount(place[of], minlength=TABLE)
        neg += np.bincount(place[~of], minlength=TABLE)
    odds = np.log((pos + 0.5) / (toxic.sum() + 1)) - np.log((neg + 0.5) / ((~toxic).sum() + 1))
    odds = np.where(pos < 3, 0, np.maximum(odds, 0))

    def best_windows(value) -> tuple[np.ndarray, np.ndarray]:
        """(start, score) of the best window of every document; start -1 for an empty one."""
        start, score = np.full(len(texts), -1), np.full(len(texts), -np.inf)
        for i, j, part, own in chunks(data, offsets):
            sums = window_sums(value(part, own), own)
            for d in range(i, j):
                if offsets[d + 1] > offsets[d]:
                    at = int(sums[own[d - i] : own[d - i + 1]].argmax())
                    start[d], score[d] = offsets[d] + at, sums[own[d - i] + at]
        return start, score

    def telling(part: np.ndarray, own: np.ndarray) -> np.ndarray:
        place, _, valid = next(subsequences(*prepared(part, own)))
        return np.where(valid, odds[place], 0.0)

    is_pos, is_neg = np.flatnonzero(toxic), np.flatnonzero(~toxic)
    starts, _ = best_windows(telling)
    chosen, hard = starts[is_pos][starts[is_pos] >= 0], starts[is_neg][starts[is_neg] >= 0]
    if not len(chosen) or not len(hard):
        return None
    background = drawn_places(rng, offsets, is_neg, 6000)
    marks = np.concatenate([rng.permutation(chosen)[: LANDMARKS * 3 // 4], background[: LANDMARKS // 4]])
    places, weights = window_features(x, block, offsets, marks)
    # Only subsequences of landmarks matter: row 0 stands for all others.
    used = np.unique(places[weights > 0])
    row = np.zeros(TABLE, np.int32)
    row[used] = np.arange(1, len(used) + 1)
    basis = np.zeros((len(used) + 1, len(marks)), np.float32)
    np.add.at(basis, (row[places], np.arange(len(marks))[:, None]), weights)

    def kernel(windows: np.ndarray, x: np.ndarray = x, block: np.ndarray = block, offsets: np.ndarray = offsets) -> np.ndarray:
        out = np.zeros((len(windows), len(marks)), np.float32)
        for i in range(0, len(windows), 512):
            p, w = window_features(x, block, offsets, windows[i : i + 512])
            for k in range(p.shape[1]):
                out[i : i + 512] += w[:, k, None] * basis[row[p[:, k]]]
        return out

    own = kernel(marks).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    keep = values > 1e-4 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    hard = np.concatenate([background, hard])
    model, extra = None, None
    for turn in range(ROUNDS):
        parts = [kernel(chosen), kernel(hard)]
        if turn == 1:
            pick = rng.permutation(chosen)[:ALTERED]
            pieces = [v for at in pick for v in altered(rng, data[max(0, at - 2) : at + WINDOW + 4].tobytes())]
            around = rng.choice(background, (len(pick), 2))
            pieces += [v for at, (a, b) in zip(pick, around, strict=True) for v in amid(rng, data[at : at + WINDOW + 3], data[a : a + REACH].tobytes(), data[b : b + REACH].tobytes())]
            extra = joined(*text_bytes(pa.array(pieces, pa.binary())))
            extra = (*extra, *prepared(*extra))
        if extra:
            own = best_starts(model, *extra[:2])
            parts.append(kernel(own, extra[2], extra[3], extra[1]))
        mapped = np.concatenate(parts) @ root
        y = np.concatenate([np.ones(len(chosen)), -np.ones(len(hard)), np.ones(len(parts[2]) if extra else 0)])
        weight = np.concatenate([np.ones(len(chosen) + len(hard)), np.full(len(y) - len(chosen) - len(hard), SHARE * len(chosen) / max(1, len(y) - len(chosen) - len(hard)))])
        w, bias = linear_svm(mapped, y, weight)
        # The norm of a window is left out of the folded weights: it is nearly the same for all.
        folded = np.zeros(TABLE, np.float32)
        folded[used] = basis[1:] @ (root @ w).astype(np.float32)
        norm = float(np.sqrt(sum(WINDOW * DECAY ** (2 * (a + b + c - 3)) for a, b, c in STEPS)))
        model = Model(folded / np.float32(norm), float(bias), 1.0, 0.0)
        starts, scores = best_windows(model.positions)
        # Toxic documents whose best window looks clean teach nothing.
        sure = is_pos[scores[is_pos] + bias > -1]
        chosen = starts[sure] if len(sure) else chosen
        hard = np.unique(np.concatenate([hard, starts[is_neg][starts[is_neg] >= 0]]))
    best = np.concatenate([model.best(part, own) for _, _, part, own in chunks(data, offsets)])
    some = np.isfinite(best)
    model.slope, model.shift = platt(best[some], toxic[some])
    return model


def linear_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 20.0, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Squared-hinge SVM with balanced classes by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    cost = weight * np.where(y > 0, 0.5 / weight[y > 0].sum(), 0.5 / weight[y < 0].sum()) * c * 100
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    active = np.ones(len(x), bool)
    for _ in range(min(rounds, 30)):
        a, k = x[active], cost[active]
        new = np.linalg.solve(ridge + (a * k[:, None]).T @ a, (a * k[:, None]).T @ y[active])
        w, before = new, active
        active = y * (x @ w) < 1
        if (active == before).all():
            break
    return w[:-1], float(w[-1])


def platt(scores: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of the labels over the scores."""
    z = np.stack([scores, np.ones(len(scores))], axis=1)
    n1, n0 = toxic.sum(), (~toxic).sum()
    aim = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + 1e-6 * np.eye(2), z.T @ (p - aim) + 1e-6 * w)
        w = w - step
        if abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_doc_bytes: int = MAX_DOC_BYTES) -> Model | None:
    """``docs``: doc_id, text; ``labels``: doc_id, toxic (0 or 1).

    Ids are picked without their texts; the few picked ids, 2 * max_docs at most, are then sent to the documents.
    """
    sizes = docs.select("doc_id", F.octet_length("text").alias("size")).where(F.col("size").between(1, max_doc_bytes))
    clear = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most")
    drawn = clear.join(sizes.select("doc_id").distinct(), "doc_id").select("doc_id", "toxic", F.xxhash64("doc_id", F.lit("toxicity")).alias("draw"))
    parts = [drawn.where(F.col("toxic") == label).orderBy("draw", "doc_id").limit(max_docs) for label in (0, 1)]
    picked = saved(parts[0].unionByName(parts[1]))
    texts = docs.join(F.broadcast(picked), "doc_id").where(F.octet_length("text").between(1, max_doc_bytes))
    rows = texts.select("draw", "toxic", "text").toPandas().sort_values(["draw", "text"])
    return fit(rows["text"].tolist(), rows["toxic"].to_numpy() == 1) if len(rows) else None


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` plus score and predicted."""
    if model is None:
        return docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})
    fewer_rows(docs)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def toxic(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0), *(held.value.score(data, offsets) for _, _, data, offsets in chunks(*text_bytes(texts), 1 << 18))]))

    return docs.withColumn("score", toxic(text)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
