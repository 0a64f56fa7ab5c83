"""Language ID by a linear-chain conditional random field over the words of a text.

A word's features are its affixes, its character pairs and triples, and the word itself (the lexicon), hashed to a
table of weights per language; transitions between neighbouring words' languages are learned along with them. A
whole text is one chain, labelled by forward-backward: it is worked on in pieces of ``CHAIN`` words side by side, and
the messages pass from piece to piece (:func:`_carried`). A text's language is the one with the largest sum of its
words' marginals, and its score their mean; :func:`labelled` gives the spans of a text by the languages of its words.

Training chains are drawn from a sample of bounded size: about ``ROWS_EACH`` texts a language, and of each at most
``CHAINS_EACH`` chains of ``CHAIN`` words; some are spliced from two texts of different languages, so that the
transitions learn switches. Only text and non-null lang of documents whose crc32(doc_id as text) mod 4 isn't
2 are learned. Null texts and texts without a letter are ``und`` with score 0, as all are if there is nothing to learn
from. Repeated rows are repeated in the result. An empty table gives no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

CHAIN = 64
#: Bound of the sample: documents of each language, about, and chains of each.
ROWS_EACH, CHAINS_EACH = 1_000, 2
SPLICED, EPOCHS, BATCH, RATE = 0.3, 4, 64, 0.3
_BITS = 18
_SLICE_CHARS = 1 << 17
_K = np.random.default_rng(4_711).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _letters(codes: np.ndarray) -> np.ndarray:
    low = np.array([chr(i).isalpha() for i in range(0x250)])
    out = low[np.minimum(codes, 0x24F)]
    high = codes >= 0x250
    if high.any():
        kinds, at = np.unique(codes[high], return_inverse=True)
        out[high] = np.array([chr(i).isalpha() for i in kinds])[at]
    return out


def _lower(text: str) -> str:
    """In lower case, letter by letter where that would change the length: places stay those of the text."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)


class Words:
    """The words (runs of letters, in lower case) of some texts, with the table rows of their features."""

    def __init__(self, texts: list[str]) -> None:
        low = [_lower(t) for t in texts]
        codes = np.frombuffer(" ".join([*low, ""]).encode("utf-32-le"), np.uint32)
        inside = np.concatenate((_letters(codes), [False])) if len(codes) else np.zeros(1, bool)
        begin = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
        end = np.flatnonzero(~inside[1:] & inside[:-1]) + 1  # exclusive
        starts = np.cumsum([0, *[len(t) + 1 for t in low]])
        self.row = np.searchsorted(starts, begin, "right") - 1
        self.begin, self.end = begin - starts[self.row], end - starts[self.row]
        size = end - begin
        # the letters alone, word after word
        letters = codes[inside[:-1]].astype(np.uint64)
        self.start = np.concatenate(([0], np.cumsum(size)))[:-1]
        last = self.start + size - 1
        down = np.uint64(64 - _BITS)

        def table(x: np.ndarray) -> np.ndarray:
            return (tokens.mix(x) >> down).astype(np.int32)

        affixes = []
        pre = np.zeros(len(begin), np.uint64)
        suf = np.zeros(len(begin), np.uint64)
        for k in range(4):
            ok = size > k
            pre = pre + np.where(ok, letters[np.minimum(self.start + k, max(0, len(letters) - 1))] + np.uint64(1), np.uint64(0)) * _K[k] if len(letters) else pre
            suf = suf + np.where(ok, letters[np.maximum(last - k, 0)] + np.uint64(1), np.uint64(0)) * _K[k] if len(letters) else suf
            if k:
                affixes += [table(pre + _K[8]), table(suf + _K[9])]
        # the word as a whole: a sum over its letters and places
        place = np.arange(len(letters)) - np.repeat(self.start, size)
        by_place = tokens.mix((letters << np.uint64(20)) + place.astype(np.uint64) + _K[10])
        whole = np.add.reduceat(by_place, self.start) if len(begin) else pre
        self.of_word = np.stack([*affixes, table(whole)], axis=1)
        before = np.concatenate(([0], letters[:-1])).astype(np.uint64) if len(letters) else letters
        after = np.concatenate((letters[1:], [0])).astype(np.uint64) if len(letters) else letters
        before[self.start], after[last] = 0, 0
        self.of_letter = np.stack([table(letters * _K[4] + after * _K[5]), table(before * _K[6] + letters * _K[4] + after * _K[7])], axis=1)

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        """Score of each language for each word."""
        if not len(self.row):
            return np.zeros((0, weights.shape[1]), np.float32)
        out = weights[self.of_word[:, 0]]
        for k in range(1, self.of_word.shape[1]):
            out += weights[self.of_word[:, k]]
        return out + np.add.reduceat(weights[self.of_letter[:, 0]] + weights[self.of_letter[:, 1]], self.start, axis=0)


def marginals(e: np.ndarray, sizes: np.ndarray, switch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward on chains: (marginals, summed pair marginals) for scores ``e[chain, place, language]``.

    Places from a chain's size on are empty: the messages pass them unchanged.
    """
    chains, places, langs = e.shape
    x = np.exp(e - e.max(axis=2, keepdims=True))
    step = np.exp(switch - switch.max())
    full = np.arange(places) < sizes[:, None]
    forward, backward = np.empty_like(x), np.ones_like(x)
    forward[:, 0] = x[:, 0] / x[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, places):
        a = (forward[:, t - 1] @ step) * x[:, t]
        a /= a.sum(axis=1, keepdims=True)
        forward[:, t] = np.where(full[:, t, None], a, forward[:, t - 1])
    for t in range(places - 2, -1, -1):
        b = (backward[:, t + 1] * x[:, t + 1]) @ step.T
        b /= b.sum(axis=1, keepdims=True)
        backward[:, t] = np.where(full[:, t + 1, None], b, backward[:, t + 1])
    gamma = forward * backward
    gamma /= gamma.sum(axis=2, keepdims=True)
    gamma *= full[:, :, None]
    pairs = np.zeros((langs, langs))
    for t in range(1, places):
        xi = forward[:, t - 1, :, None] * step * (backward[:, t] * x[:, t])[:, None, :]
        xi /= xi.sum(axis=(1, 2), keepdims=True)
        pairs += xi[full[:, t]].sum(axis=0)
    return gamma, pairs


def _gold_pairs(gold: np.ndarray, sizes: np.ndarray, langs: int) -> np.ndarray:
    full = np.arange(1, gold.shape[1]) < sizes[:, None]
    return np.bincount((gold[:, :-1] * langs + gold[:, 1:])[full], minlength=langs * langs).reshape(langs, langs)


def _training_chains(texts: list[str], labels: list[int], langs: int) -> tuple[list[str], list[tuple[list[int], list[int]]]]:
    """Texts of chains, and for each the languages of its parts with their numbers of words."""
    random = np.random.default_rng(99)
    cut: list[tuple[list[str], int]] = []
    for text, label in zip(texts, labels, strict=True):
        words = "".join(c if c.isalpha() else " " for c in text).split()
        for _ in range(min(CHAINS_EACH, 1 + len(words) // CHAIN)):
            at = int(random.integers(max(1, len(words) - CHAIN + 1)))
            if words:
                cut.append((words[at : at + CHAIN], label))
    out, parts = [], []
    for words, label in cut:
        other, another = cut[int(random.integers(len(cut)))]
        if another != label and random.random() < SPLICED:
            a = int(random.integers(4, CHAIN - 4))
            first, second = words[:a], other[: CHAIN - a]
            out.append(" ".join(first + second))
            parts.append(([label, another], [len(first), len(second)]))
        else:
            out.append(" ".join(words))
            parts.append(([label], [len(words)]))
    return out, parts


def fit(texts: list[str], labels: list[int], langs: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights[feature, language], switches[language, language]) by AdaGrad on the chains' log-likelihood."""
    chains, parts = _training_chains(texts, labels, langs)
    weights, seen = np.zeros((1 << _BITS, langs), np.float32), np.zeros((1 << _BITS, langs), np.float32)
    switch, switch_seen = np.zeros((langs, langs)), np.zeros((langs, langs))
    for epoch in range(EPOCHS):
        order = np.random.default_rng(epoch).permutation(len(chains))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            words = Words([chains[i] for i in some])
            gold_words = np.concatenate([np.repeat(*parts[i]) for i in some])
            if len(gold_words) != len(words.row):
                keep = [i for i in some if len(Words([chains[i]]).row) == sum(parts[i][1])]  # lower case changed its letters
                if not keep:
                    continue
                words, gold_words, some = Words([chains[i] for i in keep]), np.concatenate([np.repeat(*parts[i]) for i in keep]), keep
            sizes = np.bincount(words.row, minlength=len(some))
            place = np.arange(len(words.row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            e = np.zeros((len(some), CHAIN, langs))
            e[words.row, place] = words.emissions(weights)
            gold = np.zeros((len(some), CHAIN), np.int64)
            gold[words.row, place] = gold_words
            gamma, pairs = marginals(e, sizes, switch)
            error = gamma[words.row, place]
            error[np.arange(len(error)), gold_words] -= 1
            letters = np.repeat(error, np.diff(np.append(words.start, len(words.of_letter))), axis=0)
            ids = np.concatenate([words.of_word.T.ravel(), words.of_letter.T.ravel()])
            used, of = np.unique(ids, return_inverse=True)
            pull = np.concatenate([np.tile(error, (words.of_word.shape[1], 1)), np.tile(letters, (2, 1))])
            g = np.stack([np.bincount(of, pull[:, k], len(used)) for k in range(langs)], axis=1) / len(some)
            seen[used] += g * g
            weights[used] -= RATE * g / np.sqrt(seen[used] + 1e-6)
            g = (pairs - _gold_pairs(gold, sizes, langs)) / len(some)
            switch_seen += g * g
            switch -= RATE * g / np.sqrt(switch_seen + 1e-6)
    return weights, switch


def _fold(remainder: int) -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == remainder, F.lit(False))


def model(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """Fit on a sample of every language, in one task; gives the languages, weights and switches."""
    known = docs.select("doc_id", "text", "lang").where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~_fold(2))
    counts = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    langs = sorted(counts)
    shares = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(ROWS_EACH / counts[lang]))])
    sample = known.where(F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(1 << 30)) < shares[F.col("lang")] * (1 << 30))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        got = pa.Table.from_batches(held)
        got = got.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        weights, switch = fit(got.column("text").to_pylist(), [langs.index(x) for x in got.column("lang").to_pylist()], len(langs))
        packed = io.BytesIO()
        np.savez_compressed(packed, weights=weights, switch=switch)
        yield {"model": [packed.getvalue()]}

    rows = common.over_batches(sample.repartition(1), "model binary", work).collect()
    if not rows:
        return None
    got = np.load(io.BytesIO(bytes(rows[0][0])))
    return langs, got["weights"], got["switch"]


def _marked(texts: list[str | None], weights: np.ndarray, switch: np.ndarray) -> Iterator[tuple[int, int, Words, np.ndarray]]:
    """(first text, number of texts, their words, marginals of the words) for runs of texts."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last] or "") <= _SLICE_CHARS):
            size += len(texts[last] or "")
            last += 1
        words = Words([t or "" for t in texts[first:last]])
        count = np.bincount(words.row, minlength=last - first)
        place = np.arange(len(words.row)) - np.repeat(np.cumsum(count) - count, count)
        new = place % CHAIN == 0
        chain = np.cumsum(new) - 1
        gamma = np.zeros((0, weights.shape[1]))
        if len(chain):
            e = np.zeros((chain[-1] + 1, CHAIN, weights.shape[1]), np.float32)
            e[chain, place % CHAIN] = words.emissions(weights)
            gamma = _word_marginals(e, np.bincount(chain), switch.astype(np.float32), words.row[new])[chain, place % CHAIN]
        yield first, last - first, words, gamma
        first = last


def predicted(texts: list[str | None], weights: np.ndarray, switch: np.ndarray) -> Iterator[tuple[int, float]]:
    """(number of the language, or -1, and score) of each text."""
    for _, n, words, gamma in _marked(texts, weights, switch):
        total = np.stack([np.bincount(words.row, gamma[:, k], n) for k in range(weights.shape[1])], axis=1)
        count = np.bincount(words.row, minlength=n)
        best = total.argmax(axis=1)
        for i in range(n):
            yield (int(best[i]), float(min(1.0, total[i, best[i]] / count[i]))) if count[i] else (-1, 0.0)


def _carried(x: np.ndarray, sizes: np.ndarray, step: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What reaches each piece's first word from the left and its last from the right; pieces of a text are in order.

    A piece as a whole is a matrix between its first and last word's languages; messages go from piece to piece.
    """
    pieces, places, langs = x.shape
    whole = x[:, 0, :, None] * np.eye(langs, dtype=x.dtype)
    for t in range(1, places):
        on = np.flatnonzero(sizes > t)
        if not len(on):
            break
        a = (whole[on] @ step) * x[on, t][:, None, :]
        whole[on] = a / a.sum(axis=(1, 2), keepdims=True)
    new = np.concatenate(([True], text[1:] != text[:-1]))
    number = np.arange(pieces) - np.maximum.accumulate(np.where(new, np.arange(pieces), 0))
    left, right = np.ones((pieces, langs), x.dtype), np.ones((pieces, langs), x.dtype)
    by = np.argsort(number, kind="stable")
    cuts = np.searchsorted(number[by], np.arange(number.max() + 2))
    for k in range(1, len(cuts) - 1):
        at = by[cuts[k] : cuts[k + 1]]
        a = (left[at - 1, None, :] @ whole[at - 1])[:, 0] @ step
        left[at] = a / a.sum(axis=1, keepdims=True)
    for k in range(len(cuts) - 2, 0, -1):
        at = by[cuts[k] : cuts[k + 1]]
        b = (whole[at] @ right[at, :, None])[:, :, 0] @ step.T
        right[at - 1] = b / b.sum(axis=1, keepdims=True)
    return left, right


def _word_marginals(e: np.ndarray, sizes: np.ndarray, switch: np.ndarray, text: np.ndarray | None = None) -> np.ndarray:
    """As :func:`marginals`, chains in order of size so that a place is computed for those that reach it only.

    With ``text``, the text of each chain, chains of one text in a row are pieces of one chain.
    """
    x = np.exp(e - e.max(axis=2, keepdims=True))
    step = np.exp(switch - switch.max())
    left = right = np.ones((len(x), x.shape[2]), x.dtype)
    if text is not None and len(text) and (text[1:] == text[:-1]).any():
        left, right = _carried(x, sizes, step, text)
    order = np.argsort(-sizes, kind="stable")
    x = x[order]
    reach = (sizes[order, None] > np.arange(e.shape[1])).sum(axis=0)
    forward, backward = np.zeros_like(x), np.ones_like(x)
    backward[np.arange(len(x)), sizes[order] - 1] = right[order]
    forward[:, 0] = left[order] * x[:, 0]
    forward[:, 0] /= forward[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, e.shape[1]):
        a = (forward[: reach[t], t - 1] @ step) * x[: reach[t], t]
        forward[: reach[t], t] = a / a.sum(axis=1, keepdims=True)
    for t in range(e.shape[1] - 2, -1, -1):
        b = (backward[: reach[t + 1], t + 1] * x[: reach[t + 1], t + 1]) @ step.T
        backward[: reach[t + 1], t] = b / b.sum(axis=1, keepdims=True)
    gamma = forward * backward
    total = gamma.sum(axis=2, keepdims=True)
    out = np.empty_like(gamma)
    out[order] = np.divide(gamma, total, out=np.zeros_like(gamma), where=total > 0)
    return out


def labelled(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, lang): the spans of words in a row with one most likely language, in code points.

    A text without a letter has none; of equally likely languages the first by name counts.
    """
    told = docs.sparkSession.sparkContext.broadcast(model(docs))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        langs, weights, switch = told.value or ([], np.zeros((1, 1)), None)
        for batch in common.parts(batches if langs else iter(())):
            for first, _, words, gamma in _marked(batch.column("text").to_pylist(), weights, switch):
                best = gamma.argmax(axis=1)
                new = np.flatnonzero(np.concatenate(([True], (best[1:] != best[:-1]) | (words.row[1:] != words.row[:-1]))) if len(best) else best)
                last = np.append(new[1:], len(best)) - 1
                if len(new):
                    yield {
                        "doc_id": batch.column("doc_id").take(pa.array(first + words.row[new])),
                        "start": words.begin[new], "end": words.end[last], "lang": [langs[k] for k in best[new]],
                    }

    return common.over_batches(docs.select("doc_id", "text"), "doc_id long, start long, end long, lang string", work)


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs(doc_id, text, lang)``."""
    told = docs.sparkSession.sparkContext.broadcast(model(docs))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        langs, weights, switch = told.value or ([], np.zeros((1, 1)), None)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                got = list(predicted(part.column("text").to_pylist(), weights, switch)) if langs else [(-1, 0.0)] * part.num_rows
                yield {"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "lang_pred": [langs[k] if k >= 0 else "und" for k, _ in got], "score": [s for _, s in got]}

    return common.over_batches(docs.select("doc_id", _fold(2).alias("held_out"), "text"), "doc_id long, held_out boolean, lang_pred string, score double", work)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(common.table(spark, sf_dir, "documents"))
