"""Language of documents by a linear-chain conditional random field over words.

Each word gets emission scores from hashed features (affixes, character n-grams, the word itself where it is in the lexicon) and
labels follow each other by learned transitions. Forward-backward gives each word's label probabilities, also inside code-switched
text; a document's language is the one with most probability over its words.

Training sequences are spans of labelled documents' whole texts, joined at random, so that transitions within and between languages are learned.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrowtext import group_sums, kept, steps, text_column, tidy, words
from .common import durable, held_out, training_row

#: Hashed feature slots; words a worker remembers.
SLOTS, CACHE_WORDS = 1 << 16, 300_000
#: Words of a block in forward-backward: long chains are worked in blocks side by side, and states are carried from block to block.
BLOCK = 128


#: Slots of short features, which words share; a worker's memory of bounded size.
_SLOT: dict[str, int] = {}


def _slot(feature: str) -> int:
    slot = zlib.crc32(feature.encode("utf-8", "replace")) % SLOTS
    if len(feature) < 5 and len(_SLOT) < 200_000:
        _SLOT[feature] = slot
    return slot


def word_features(word: str, lexicon: frozenset[str]) -> list[int]:
    """Slots of the word's features: affixes of one to four letters, all bigrams and trigrams, the word if in the lexicon, its shape."""
    w = f"<{word}>"
    f = dict.fromkeys([*["p" + w[: n + 1] for n in (1, 2, 3, 4)], *["s" + w[-n - 1 :] for n in (1, 2, 3, 4)], *[w[i : i + 2] for i in range(len(w) - 1)], *[w[i : i + 3] for i in range(len(w) - 2)], "a" if word.isascii() else "u"])
    out = [known if (known := _SLOT.get(x)) is not None else _slot(x) for x in f]
    return [*out, _slot("w" + word)] if word in lexicon else out


@dataclass
class Chain:
    """Emission weights, transitions and start scores of a trained field."""

    langs: list[str]
    lexicon: frozenset[str]
    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray

    def mark(self) -> tuple[int, int]:
        """What tells this field's weights from another's."""
        return zlib.crc32(self.emission.tobytes()), zlib.crc32("\n".join([*self.langs, *sorted(self.lexicon)]).encode("utf-8", "replace"))

    def emissions(self, some: list[str]) -> np.ndarray:
        feats = [word_features(w, self.lexicon) for w in some]
        n = np.array([len(f) for f in feats], np.int64)
        if not len(n):
            return np.zeros((0, len(self.langs)))
        flat = np.array([i for f in feats for i in f], np.int64)
        return np.add.reduceat(self.emission[flat], np.cumsum(n) - n, axis=0) / np.sqrt(n)[:, None]


def _normal(v: np.ndarray) -> np.ndarray:
    return v / v.sum(-1, keepdims=True)


def _entries(x: np.ndarray, t: np.ndarray, first: np.ndarray, size: np.ndarray, chain: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each block of the chains: the state before its first word (a chain's first block: none), and the backward state at its last word.

    A block's words act on a state as the product of their matrices. These products are formed for all blocks side by side; states then
    pass from block to block, over all chains at once.
    """
    k, n = x.shape[1], len(first)
    product = np.repeat(np.eye(k)[None], n, 0)
    for j in range(int(size.max())):
        live = np.flatnonzero(size > j)
        step = product[live] @ t * x[first[live] + j][:, None, :]
        product[live] = step / step.sum((1, 2), keepdims=True)
    place = np.arange(n) - np.searchsorted(chain, chain)  # of the block in its chain
    ahead = np.append(chain[1:] == chain[:-1], False)
    before, after = np.ones((n, k)), np.ones((n, k))
    for p in range(1, int(place.max()) + 1):
        own = np.flatnonzero(place == p)
        if p == 1:  # no transition leads to a chain's first word
            heads = own - 1
            v = np.exp(start - start.max()) * x[first[heads]]
            for j in range(1, BLOCK):
                live = size[heads] > j
                v[live] = _normal(v[live] @ t * x[first[heads[live]] + j])
            before[own] = _normal(v)
        else:
            before[own] = _normal((before[own - 1][:, None, :] @ product[own - 1])[:, 0])
    for p in range(int(place.max()) - 1, -1, -1):
        own = np.flatnonzero((place == p) & ahead)
        after[own] = _normal((product[own + 1] @ after[own + 1][:, :, None])[:, :, 0])
    return before, after


def forward_backward(e: np.ndarray, lengths: np.ndarray, transition: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word posteriors of many chains at once, expected transitions, and log probabilities of the words whose sums are the chains' log partition sums.

    ``e``: emission scores of all words, chain after chain. Chains are cut into blocks that run side by side; what enters a block
    from both sides is found first, so the result is that of the whole chain.
    """
    k = e.shape[1]
    top = e.max(1)
    x = np.exp(e - top[:, None])
    t = np.exp(transition)
    pieces = -(-lengths // BLOCK)
    chain = np.repeat(np.arange(len(lengths)), pieces)
    at = (np.arange(len(chain)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * BLOCK
    sizes = np.minimum(lengths[chain] - at, BLOCK)
    first = (np.cumsum(lengths) - lengths)[chain] + at
    head, joined = at == 0, np.append(chain[1:] == chain[:-1], False) if len(chain) else np.zeros(0, bool)
    before, after = np.ones((len(chain), k)), np.ones((len(chain), k))
    many = (pieces > 1)[chain]
    if many.any():
        before[many], after[many] = _entries(x, t, first[many], sizes[many], chain[many], start)
    order = np.argsort(-sizes, kind="stable")
    first_, sizes_ = first[order], sizes[order]
    enter = np.where(head[order][:, None], np.exp(start), before[order] @ t)
    alpha, scale = np.empty_like(x), np.empty(len(x))
    most = int(sizes_[0]) if len(sizes_) else 0
    live = [int(np.searchsorted(-sizes_, -j, "left")) for j in range(most + 1)]  # blocks longer than j
    a = None
    for j in range(most):
        here = first_[: live[j]] + j
        a = x[here] * (enter if j == 0 else a[: live[j]] @ t)
        z = a.sum(1)
        a = a / z[:, None]
        alpha[here], scale[here] = a, z
    beta = np.ones_like(x)
    last = first + sizes - 1
    inner = last[joined]
    beta[inner] = after[joined] / (alpha[inner] * after[joined]).sum(1, keepdims=True)
    expected = np.zeros((k, k))
    for j in range(most - 2, -1, -1):
        here = first_[: live[j + 1]] + j
        nxt = x[here + 1] * beta[here + 1] / scale[here + 1][:, None]
        beta[here] = nxt @ t.T
        expected += (alpha[here].T @ nxt) * t
    expected += (alpha[inner].T @ (x[inner + 1] * beta[inner + 1] / scale[inner + 1][:, None])) * t
    return alpha * beta, expected, np.log(scale) + top


def train(sentences: list[list[str]], labels: list[list[int]], langs: list[str], lexicon: frozenset[str], *, rounds: int = 12, l2: float = 1e-4, rate: float = 0.3, seed: int = 7) -> Chain:
    """Maximum likelihood by AdaGrad over batches of sequences."""
    k = len(langs)
    m = Chain(langs, lexicon, np.zeros((SLOTS, k)), np.eye(k), np.zeros(k))
    if not sentences:
        return m
    distinct = {w: i for i, w in enumerate(dict.fromkeys(w for s in sentences for w in s))}
    feats = [np.array(word_features(w, lexicon), np.int64) for w in distinct]
    ge, gt, gs = np.full((SLOTS, k), 1e-2), np.full((k, k), 1.0), np.full(k, 1.0)
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for batch in np.array_split(rng.permutation(len(sentences)), max(1, len(sentences) // 64)):
            code = np.array([distinct[w] for i in batch for w in sentences[i]], np.int64)
            y = np.array([c for i in batch for c in labels[i]], np.int64)
            n = np.array([len(sentences[i]) for i in batch], np.int64)
            own, back = np.unique(code, return_inverse=True)
            size = np.array([len(feats[c]) for c in own])
            flat = np.concatenate([feats[c] for c in own])
            scale = 1 / np.sqrt(size)
            e = (np.add.reduceat(m.emission[flat], np.cumsum(size) - size, axis=0) * scale[:, None])[back]
            post, expected, _ = forward_backward(e, n, m.transition, m.start)
            diff = post
            diff[np.arange(len(y)), y] -= 1
            by_word = np.zeros((len(own), k))
            np.add.at(by_word, back, diff)
            g = np.zeros((SLOTS, k))
            np.add.at(g, flat, np.repeat(by_word * scale[:, None], size, axis=0))
            used = np.unique(flat)
            g = g[used] / len(batch) + l2 * m.emission[used]
            ge[used] += g * g
            m.emission[used] -= rate * g / np.sqrt(ge[used])
            inside = np.ones(len(y), bool)
            inside[np.cumsum(n) - 1] = False
            seen = np.zeros((k, k))
            np.add.at(seen, (y[:-1][inside[:-1]], y[1:][inside[:-1]]), 1)
            d = (expected - seen) / len(batch) + l2 * m.transition
            gt += d * d
            m.transition -= rate * d / np.sqrt(gt)
            f = np.cumsum(n) - n
            d = diff[f].sum(0) / len(batch)
            gs += d * d
            m.start -= rate * d / np.sqrt(gs)
    return m


def language_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words without marks and digits round or inside them, and each text's offsets; words without letters are left out."""
    flat, off = words(texts, unicode=True)
    d = flat.dictionary_encode() if len(flat) else None
    if d is None:
        return pa.array([], pa.large_string()), off
    clean = pc.utf8_lower(pc.replace_substring_regex(d.dictionary, r"[^\pL\pM'’]+|^['’]+|['’]+$", ""))
    keep = np.asarray(pc.match_substring_regex(clean, r"\pL"), bool)
    code = d.indices.to_numpy(zero_copy_only=False)
    full = keep[code]
    before = np.concatenate([[0], np.cumsum(full)])
    return pa.DictionaryArray.from_arrays(pa.array(code[full]), clean), before[off]


def memory_of(model: Chain) -> dict[str, np.ndarray]:
    """The worker's memory of words' emissions under this field."""
    return kept("language", model.mark())


def posteriors(texts: pa.Array, model: Chain, memory: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Summed word probabilities of each language per text, and the texts' numbers of words."""
    k = len(model.langs)
    coded_words, off = language_words(texts)
    n = np.diff(off)
    if not len(coded_words) or not k:
        return np.zeros((len(texts), k)), n
    distinct = coded_words.dictionary.to_pylist()
    if len(memory) > CACHE_WORDS:
        memory.clear()
    code = coded_words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    used = np.unique(code)
    if new := [w for w in dict.fromkeys(distinct[i] for i in used.tolist()) if w not in memory]:
        for a in range(0, len(new), 20_000):
            memory.update(zip(new[a : a + 20_000], model.emissions(new[a : a + 20_000]), strict=True))
    table = np.zeros((len(distinct), k))
    table[used] = np.array([memory[distinct[i]] for i in used.tolist()])
    post, _, _ = forward_backward(table[code], n, model.transition, model.start)
    return np.column_stack([group_sums(np.ascontiguousarray(post[:, c]), off) for c in range(k)]), n


def training_texts(docs: DataFrame, *, rows_per_language: int, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, list[str]]]:
    """(language, words of the whole text) of a bounded sample: of each language ``rows_per_language`` ids, those of the smallest xxhash64(id).

    An id that several rows of a language share teaches by one of them, the text of the smallest xxhash64.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null").where(training_row("doc_id"))
    # ranked in 64 salted parts of each language first; a part's task keeps rows_per_language ids
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    known = named.groupBy("doc_id", "lang").agg(F.lit(1).alias("one")).withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(64)))
    known = known.withColumn("r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("r") <= rows_per_language)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    chosen = durable(known.withColumn("r", rank).where(F.col("r") <= rows_per_language).select("doc_id", "lang"))
    rows = named.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    @tidy
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch, "text")
            w, off = language_words(texts)
            out = [w.slice(int(off[i]), int(off[i + 1] - off[i])).to_pylist() for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["lang", "words"])

    got = rows.select("lang", "text").mapInArrow(split, "lang string, words array<string>").collect()  # rows_per_language of each language
    return sorted((r.lang, list(r.words)) for r in got)


def fit_languages(docs: DataFrame, *, rows_per_language: int = 100, span_words: int = 24, lexicon_size: int = 4000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", seed: int = 7) -> Chain:
    """A field learned from the whole texts of ``rows_per_language`` rows of each language, cut into spans that are joined at random."""
    rows = training_texts(docs, rows_per_language=rows_per_language, id_col=id_col, text_col=text_col, lang_col=lang_col)
    langs = sorted({lang for lang, _ in rows})
    count = Counter(w for _, s in rows for w in set(s))
    lexicon = frozenset(w for w, n in sorted(count.items(), key=lambda x: (-x[1], x[0]))[:lexicon_size] if n > 1)
    pieces = [(langs.index(lang), s[a : a + span_words]) for lang, s in rows for a in range(0, len(s), span_words)]
    rng = np.random.default_rng(seed)
    order, sentences, labels = rng.permutation(len(pieces)), [], []
    at = 0
    while at < len(order):  # one to three spans to a sequence, as in text that switches
        take = order[at : at + int(rng.integers(1, 4))]
        at += len(take)
        sentences.append([w for i in take for w in pieces[i][1]])
        labels.append([pieces[i][0] for i in take for _ in pieces[i][1]])
    return train(sentences, labels, langs, lexicon, seed=seed)


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_language: int = 100) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    ``lang_pred`` is the language with the largest share of word probability over the whole text, ties to the first by name;
    ``score`` that share. A text that is null or has no letter gets 'und' and 0, as does every text if no language could be
    learned. Languages are learned from the whole texts of ``rows_per_language`` rows of each, out of rows with a language whose
    crc32(doc_id as text) mod 5 is not 0; nothing but the text enters a prediction. A null id is neither a training row nor held
    out. A text is one chain, however long; words end at Unicode white space, and all of a word's characters count. Repeated rows get a row
    each. Other columns are not read. An empty table gives an empty result.
    """
    model = fit_languages(docs, rows_per_language=rows_per_language, id_col=id_col, text_col=text_col, lang_col=lang_col)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, memory = np.array([*model.langs, "und"], object), memory_of(model)
        for batch in batches:
            texts = text_column(batch, "text")
            for a, b in steps(texts, 2 << 20):
                share, n = posteriors(texts.slice(a, b - a), model, memory)
                best = share.argmax(1) if share.shape[1] else np.zeros(b - a, np.int64)
                known = (n > 0) & (share.shape[1] > 0)
                pick = np.where(known, best, len(model.langs))
                score = np.where(known, share.max(1, initial=0) / np.maximum(n, 1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(names[pick].tolist(), pa.string()), pa.array(np.clip(score, 0, 1))], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double").select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
