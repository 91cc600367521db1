"""Language of words and texts by a linear-chain conditional random field.

The words of a text are a chain whose labels are the languages.  A word speaks for a language
by its affixes, its n-grams and its place in the lexicon of frequent words; transitions say
how readily a writer switches.  Weights and transitions are learned together, by gradient
ascent on the likelihood of chains that are put together from stretches of labelled texts,
so that they hold switches.  The forward-backward pass gives each word its probabilities; a
text's language is the one that most of its words are expected to be in.

Everything is vectorised: features over the bytes of many texts, the passes over all texts
of a batch at a time, word by word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from leadtide.llm.common import examples, pieces, split_of

#: Labelled rows of each language that are learned from, the first by a hash of doc_id.
SAMPLE_ROWS = 250
#: Slots that hashed features share; words of the lexicon have slots of their own beyond.
SLOTS = 1 << 15
LEXICON = 1 << 14
#: Words of a language's lexicon, and how often each was seen at least.
LEXICON_WORDS, LEXICON_SEEN = 2000, 5
#: Words of the stretches and of the chains that are learned from.
STRETCH, CHAIN = (6, 24), 64
EPOCHS, RATE = 3, 0.3
FEATURE_BYTES, BATCH_BYTES = 1 << 20, 12 << 20
_LETTER = regex.compile(r"\p{L}")
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_MIX = np.random.default_rng(7).integers(0, 1 << 63, (64, 256), dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # slots x languages
    transitions: np.ndarray  # from x to, as factors
    lexicon: np.ndarray  # the hash of the word that owns each lexicon slot


def _slot(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return (x * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(49)).astype(np.int64)


def words_of(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end, place of each text's first word) of the runs of letters; no word spans texts."""
    inside = np.zeros(len(raw) + 1, bool)
    inside[:-1] = _IS_LETTER[raw]
    cut = starts[(starts > 0) & (starts < len(raw))]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[cut] |= inside[cut]
    ends = ~inside
    ends[1:] &= inside[:-1]
    ends[0] = False
    ends[cut] |= inside[cut - 1]
    first, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return first, end, np.searchsorted(first, starts)


def word_hashes(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, by its letters and their places."""
    if not len(first):
        return np.zeros(0, np.uint64)
    begun = np.zeros(len(raw), np.int64)
    begun[first] = first
    begun = np.maximum.accumulate(begun)
    mixed = np.where(_IS_LETTER[raw], _MIX[(np.arange(len(raw)) - begun) & 63, raw], np.uint64(0))
    return np.add.reduceat(mixed, first, dtype=np.uint64)


def emissions(raw: np.ndarray, first: np.ndarray, end: np.ndarray, model: Model) -> np.ndarray:
    """The score of each word for each language."""
    if not len(first):
        return np.zeros((0, len(model.languages)), np.float32)
    affixes, grams, lexicon = features(raw, first, end, model.lexicon)
    out = model.weights[lexicon].copy()
    for slots in affixes:
        out += model.weights[slots]
    for slots in grams:
        out += np.add.reduceat(model.weights[slots], first)
    return out


def features(raw: np.ndarray, first: np.ndarray, end: np.ndarray, lexicon: np.ndarray) -> tuple[list, list, np.ndarray]:
    """Slots of the affixes (one for each word and kind), of the n-grams (one for each byte
    and kind; those of bytes outside words go to the last slot, whose weight stays zero),
    and of the lexicon."""
    nothing = SLOTS + LEXICON
    padded = np.concatenate([raw, np.zeros(4, np.uint8)]).astype(np.uint64)
    size = end - first
    affixes = []
    head, tail = np.zeros(len(first), np.uint64), np.zeros(len(first), np.uint64)
    for n in range(1, 5):
        enough = size >= n
        head = head << np.uint64(8) | np.where(enough, padded[np.minimum(first + n - 1, len(raw))], 0)
        tail = tail << np.uint64(8) | np.where(enough, padded[np.maximum(end - n, 0)], 0)
        if n > 1:
            affixes.append(np.where(enough, _slot(head, 11 * n), nothing))
            affixes.append(np.where(enough, _slot(tail, 13 * n), nothing))
    inside = _IS_LETTER[raw]
    word_end = np.zeros(len(raw), np.int64)
    word_end[first] = end
    word_end = np.maximum.accumulate(word_end)
    rest = word_end - np.arange(len(raw))  # letters from here to the end of the word
    grams = []
    gram = padded[: len(raw)]
    for n in (2, 3):
        gram = gram << np.uint64(8) | padded[n - 1 : len(raw) + n - 1]
        grams.append(np.where(inside & (rest >= n), _slot(gram, 17 * n), nothing))
    whole = word_hashes(raw, first)
    own = (whole % np.uint64(LEXICON)).astype(np.int64)
    return affixes, grams, np.where(lexicon[own] == whole, SLOTS + own, nothing)


def forward_backward(
    scores: np.ndarray, starts: np.ndarray, transitions: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """The probabilities of each word's labels, and (with ``pairs``) the expected transitions.

    All chains advance together, one word at a time, longest first; what is kept in between
    is scaled to sum to one.
    """
    k = scores.shape[1]
    size = np.diff(starts)
    by = np.argsort(-size, kind="stable")
    by = by[size[by] > 0]
    longest = int(size[by[0]]) if len(by) else 0
    active = np.searchsorted(-size[by], -np.arange(longest), "left") if longest else np.zeros(0, np.int64)
    offset = np.concatenate([[0], np.cumsum(active)])
    chain = np.arange(size[by].sum()) - np.repeat(np.cumsum(size[by]) - size[by], size[by])
    rank = np.repeat(np.arange(len(by)), size[by])
    place = offset[chain] + rank  # in order of the words, then of the chains
    source = np.repeat(starts[by], size[by]) + chain
    factor = np.empty((len(place), k), np.float32)
    factor[place] = np.exp(scores[source] - scores[source].max(axis=1, keepdims=True))
    alpha = np.empty_like(factor)
    transitions = transitions.astype(np.float32)
    for t in range(longest):
        n, at = active[t], offset[t]
        a = factor[at : at + n] if t == 0 else (alpha[offset[t - 1] : offset[t - 1] + n] @ transitions) * factor[at : at + n]
        alpha[at : at + n] = a / a.sum(axis=1, keepdims=True)
    expected = np.zeros((k, k)) if pairs else None
    beta = np.ones((len(by), k), np.float32)
    for t in range(longest - 1, -1, -1):
        n, at = active[t], offset[t]
        if t + 1 < longest:
            m, after = active[t + 1], offset[t + 1]
            ahead = factor[after : after + m] * beta[:m]
            if pairs:
                joint = alpha[at : at + m][:, :, None] * transitions[None] * ahead[:, None, :]
                expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = ahead @ transitions.T
            beta[:m] = b / b.sum(axis=1, keepdims=True)
        p = alpha[at : at + n] * beta[:n]
        alpha[at : at + n] = p / p.sum(axis=1, keepdims=True)
    out = np.zeros((len(scores), k), np.float32)
    out[source] = alpha[place]
    return out, expected


def _chains(texts: list[tuple[bytes, int]], lexicon_of: int) -> tuple[list[tuple[bytes, list[int]]], np.ndarray]:
    """Chains of stretches of the texts in a fixed random order, and the lexicon.

    A text gives all its words; stretches of STRETCH words meet stretches of other texts.
    """
    random = np.random.default_rng(7)
    stretches = []
    seen = [Counter() for _ in range(lexicon_of)]
    for raw, label in texts:
        first, end, _ = words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        words = [raw[f:e] for f, e in zip(first.tolist(), end.tolist())]
        seen[label].update(words)
        at = 0
        while at < len(words):
            n = int(random.integers(*STRETCH))
            stretches.append((words[at : at + n], label))
            at += n
    chains, words, labels = [], [], []
    for i in random.permutation(len(stretches)).tolist():
        words += stretches[i][0]
        labels += [stretches[i][1]] * len(stretches[i][0])
        if len(words) >= CHAIN:
            chains.append((b" ".join(words), labels))
            words, labels = [], []
    if words:
        chains.append((b" ".join(words), labels))
    lexicon = np.zeros(LEXICON, np.uint64)
    for known in seen:
        often = [w for w, n in sorted(known.items(), key=lambda x: (-x[1], x[0]))[:LEXICON_WORDS] if n >= LEXICON_SEEN]
        raw = np.frombuffer(b" ".join(often), np.uint8)
        first, _, _ = words_of(raw, np.array([0, len(raw)]))
        whole = word_hashes(raw, first)
        for h in whole[::-1].tolist():  # of words that share a slot the most frequent one has it
            lexicon[h % LEXICON] = h
    return chains, lexicon


def train(texts: list[tuple[str, str]]) -> Model:
    """From (text, language); rows whose text has no letter are no examples."""
    texts = sorted((t, lang) for t, lang in texts if t and lang is not None and _LETTER.search(t))
    languages = sorted({lang for _, lang in texts})
    k = len(languages)
    number = {lang: i for i, lang in enumerate(languages)}
    chains, lexicon = _chains([(t.lower().encode(), number[lang]) for t, lang in texts], k)
    model = Model(languages, np.zeros((SLOTS + LEXICON + 1, k), np.float32), np.ones((k, k)) / max(k, 1), lexicon)
    logs = np.zeros((k, k))
    squares, switch_squares = np.full_like(model.weights, 1e-2), np.full((k, k), 1e-2)
    random = np.random.default_rng(77)
    for _ in range(EPOCHS if k > 1 else 0):
        order = random.permutation(len(chains))
        for some in np.array_split(order, max(1, len(order) // 200)):
            raw = np.frombuffer(b" ".join(chains[i][0] for i in some) + b" ", np.uint8)
            starts = np.concatenate([[0], np.cumsum([len(chains[i][0]) + 1 for i in some])])
            labels = np.concatenate([chains[i][1] for i in some])
            first, end, of_text = words_of(raw, starts)
            affixes, grams, own = features(raw, first, end, lexicon)
            scores = model.weights[own].copy()
            for slots in affixes:
                scores += model.weights[slots]
            for slots in grams:
                scores += np.add.reduceat(model.weights[slots], first)
            p, expected = forward_backward(scores, of_text, np.exp(logs), pairs=True)
            gap = -p
            gap[np.arange(len(labels)), labels] += 1
            slots = np.concatenate([own, *affixes, *grams])
            of_word = np.arange(len(first))
            of_byte = np.maximum(np.searchsorted(first, np.arange(len(raw)), "right") - 1, 0)
            word = np.concatenate([of_word] * (1 + len(affixes)) + [of_byte] * len(grams))
            step = np.stack([
                np.bincount(slots, gap[word, j], minlength=SLOTS + LEXICON + 1) for j in range(k)
            ], axis=1) / np.sqrt(len(first)) - 1e-4 * model.weights
            step[-1] = 0  # the slot of nothing
            squares += step * step
            model.weights[:] += (RATE * step / np.sqrt(squares)).astype(np.float32)
            seen = np.zeros((k, k))
            inner = np.ones(len(labels), bool)
            inner[of_text[1:-1]] = False
            np.add.at(seen, (labels[:-1][inner[1:]], labels[1:][inner[1:]]), 1)
            step = (seen - expected) / np.sqrt(len(first))
            switch_squares += step * step
            logs += RATE * step / np.sqrt(switch_squares)
    return Model(languages, model.weights, np.exp(logs - logs.max(initial=0.0)), lexicon)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most ``sample_rows`` rows of each language outside the held-out quarter (runs a
    job).  Rows without doc_id are no examples; a repeated doc_id counts once, with its least text."""
    labelled = docs.where(F.col("lang").isNotNull() & (split_of(F.col("doc_id")) != 2))
    rank = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        labelled.where(F.col("doc_id").isNotNull()).select("doc_id", "lang")
        .withColumn("nth", F.row_number().over(rank)).where(F.col("nth") <= sample_rows)
        .groupBy("doc_id").agg(F.min("lang").alias("lang"))
    )
    rows = examples(docs, chosen).select("text", "lang").toArrow()  # bounded by sample_rows
    return train(list(zip(rows["text"].to_pylist(), rows["lang"].to_pylist())))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and words (the number of words expected in each
    language) of each row.

    lang_pred is `und`, with score 0, for null texts and those without a letter (or if no
    language was learned); else the language most words are expected in, and their share.
    Ties go to the first language by name.  Only the text counts; doc_id is passed on.
    """
    k = len(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            texts = [(t or "").lower().encode() for t in batch.column("text").to_pylist()]
            spoken = np.array([bool(t and _LETTER.search(t)) for t in batch.column("text").to_pylist()], bool)
            sizes = np.cumsum([0, *map(len, texts)])
            scores, counts = [], [np.zeros(1, np.int64)]
            first = 0
            while first < len(texts):  # features of some texts at a time
                last = max(first + 1, int(np.searchsorted(sizes, sizes[first] + FEATURE_BYTES, "right")) - 1)
                raw = np.frombuffer(b"".join(texts[first:last]), np.uint8)
                begin, end, of_text = words_of(raw, sizes[first : last + 1] - sizes[first])
                scores.append(emissions(raw, begin, end, model))
                counts.append(np.diff(of_text))
                first = last
            starts = np.cumsum(np.concatenate(counts))
            words = np.zeros((len(texts), k))
            if k:
                p, _ = forward_backward(np.concatenate(scores), starts, model.transitions)
                total = np.concatenate([np.zeros((1, k)), np.cumsum(p, axis=0, dtype=np.float64)])
                words = total[starts[1:]] - total[starts[:-1]]
            spoken &= words.sum(axis=1) > 0 if k else False
            best = words.argmax(axis=1) if k else np.zeros(len(texts), np.int64)
            share = np.where(spoken, words.max(axis=1, initial=0.0) / np.maximum(words.sum(axis=1), 1e-9), 0.0)
            names = np.array([*model.languages, "und"], object)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array(names[np.where(spoken, best, k)], pa.string()), pa.array(np.clip(share, 0.0, 1.0)),
                 pa.array(list(words), pa.list_(pa.float64()))],
                ["doc_id", "held_out", "lang_pred", "score", "words"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (split_of(F.col("doc_id")) == 2).alias("held_out"), "text"
    )
    return rows.mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, words array<double>"
    )


def languages(docs: DataFrame) -> DataFrame:
    """Fit on the labelled rows and identify every document; see ``fit`` and ``identify``."""
    return identify(docs, fit(docs))


def _lowered(text: str) -> str:
    """In lower case, with each character at its place; one that would become two stays as it is."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def word_runs(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and runs (start, end, lang) of each row: stretches of words whose most probable label is one language.

    Labels are those of largest probability by forward-backward, ties to the first language by
    name.  A run goes from its first word's beginning to its last word's end, in code points of
    the text, end exclusive; the runs of a text hold all its words in order, and neighbours differ
    in language.  Null texts, those without a letter, and all texts if no language was
    learned have an empty list.  Rows that repeat come out as often; other columns play no part.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, FEATURE_BYTES):
            texts = [t if t and model.languages and _LETTER.search(t) else "" for t in batch.column("text").to_pylist()]
            coded = [_lowered(t).encode() for t in texts]
            starts = np.cumsum([0, *map(len, coded)])
            raw = np.frombuffer(b"".join(coded), np.uint8)
            first, end, of_text = words_of(raw, starts)
            found: list[list[dict]] = [[] for _ in texts]
            if len(first):
                p, _ = forward_backward(emissions(raw, first, end, model), of_text, model.transitions)
                label, owner = p.argmax(axis=1), np.searchsorted(of_text, np.arange(len(first)), "right") - 1
                change = (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])
                begins = np.concatenate([[0], np.flatnonzero(change) + 1])
                lasts = np.concatenate([begins[1:], [len(first)]]) - 1
                point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before each byte
                whose = owner[begins]
                low = point[first[begins]] - point[starts[whose]]
                high = point[end[lasts]] - point[starts[whose]]
                for i, a, b, k in zip(whose.tolist(), low.tolist(), high.tolist(), label[begins].tolist()):
                    found[i].append({"start": a, "end": b, "lang": model.languages[k]})
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "runs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, runs array<struct<start: long, end: long, lang: string>>")
