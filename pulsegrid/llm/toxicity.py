"""Toxicity of documents after noisy-channel deobfuscation.

A character language model is counted over all documents: n-grams of ``ORDER`` letters with word boundaries, none across
documents, counted in each task and summed by n-gram. The model is a sorted table of the n-grams that occur, so it grows with the
corpus and tells all n-grams apart; shorter ones are ranges of it. Letters are a to z and ``OTHERS`` classes of all others,
which bounds it at 64 to the power ``ORDER`` rows. Words that may be disguised (letters mixed with signs that
look like letters, also at the ends, in quotes or brackets, or around hyphens and apostrophes; letters held three times
or more, or nearly all held; letters one by one with spaces or runs of signs between them) become lattices: each sign may be a letter or
itself, a held letter may be one, a gap may be none. Viterbi decoding finds the likeliest reading under the model and the
channel's costs (every context is kept: of ORDER - 1 letters, with three or four readings each, there are few); what
stands for itself stays as written. A word that is not suspicious has one reading, itself.

The restored words are scored: indicators of words and of their beginnings, in the linear model of ``quality.py`` on a
bounded sample of labelled rows. Every document is scored over its whole text; null text is empty, and a text without
words gets the score of the bias. Labels are handled as in ``quality.train``. An empty table gives an empty result. Repeated rows
each get a score, the same one. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm import quality, words

ORDER = 4
#: Bits of a letter in an n-gram, and classes of the letters other than a to z.
LETTER_BITS, OTHERS = 6, 37
#: Letters counted together before the counts are handed on.
STRETCH = 4 << 20
#: Weight of the shorter context.
BACKOFF = 4.0
#: Log costs of the channel: a sign for a letter, a sign for itself, a letter held on, a gap inside a word.
SWAP, KEEP, HOLD, JOIN = -1.0, -4.0, -4.0, -1.0
CACHE = 100_000

#: Signs that stand for letters.
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c"}
#: Those that are common around a word as themselves, at no cost there.
OUTER = "!("

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOKS_LIKE]] = True
_GAP = np.zeros(256, bool)
_GAP[[ord(c) for c in ".-_*~/,"]] = True
_OUTER = np.zeros(256, bool)
_OUTER[[ord(c) for c in OUTER]] = True
_INNER = _GAP.copy()
_INNER[ord("'")] = True
#: Bytes that go on a character.
_ON = np.zeros(256, bool)
_ON[128:192] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_COUNTS_ARROW = pa.schema([("code", pa.int32()), ("n", pa.int64())])


def _codes(texts: list[str]) -> np.ndarray:
    """One number for each place of the texts: the n-gram that starts there, with what lies beyond its text as boundary."""
    points = np.frombuffer((" " + " \0 ".join(texts) + " ").lower().encode("utf-32-le", "replace"), "<u4").astype(np.int32)
    ends = points == 0
    own = np.where((points >= 97) & (points <= 122), points - 96, np.where(points >= 170, 27 + points % OTHERS, 0))
    # One boundary between words.
    some = (own != 0) | ends
    some[1:] |= some[:-1].copy()
    some[0] = True
    own, ends = own[some], ends[some]
    code, inside = own.copy(), np.ones(len(own), bool)
    for k in range(1, ORDER):
        inside[: len(own) - k] &= ~ends[k:]
        inside[len(own) - k :] = False
        code <<= LETTER_BITS
        code[: len(own) - k] |= np.where(inside[: len(own) - k], own[k:], 0)
    return code[~ends]


def _code(gram: str) -> int:
    code = 0
    for c in gram:
        point = ord(c)
        code = code << LETTER_BITS | (point - 96 if 97 <= point <= 122 else 27 + point % OTHERS if point >= 170 else 0)
    return code


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def out() -> pa.RecordBatch:
        codes, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(codes, pa.int32()), pa.array(n, pa.int64())], schema=_COUNTS_ARROW)

    for batch in batches:
        texts = words.texts_of(batch, "text")
        for lo, hi in words.groups(texts, 1 << 20):
            held.append(_codes(texts[lo:hi].to_pylist()))
            if sum(map(len, held)) >= STRETCH:
                yield out()
                held.clear()
    if held:
        yield out()


Model = tuple[np.ndarray, np.ndarray]


def language_model(docs: DataFrame, text_col: str = "text") -> Model:
    """The n-grams of all documents in order, and how often the first 0, 1, 2, ... of them occur."""
    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(_counted, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    made = counts.toArrow()  # a row per n-gram that occurs, bounded by the alphabet
    codes, n = (made.column(c).to_numpy() for c in ("code", "n"))
    order = np.argsort(codes)
    return codes[order].astype(np.int32), np.r_[0, np.cumsum(n[order])].astype(np.int64)


class Decoder:
    """Viterbi decoding under a language model; readings and probabilities met before are remembered, up to a bound."""

    def __init__(self, model: Model):
        (self.codes, self.sums), self.known, self.readings = model, {}, {}
        self.total = self._count(" ") * 6 + 1000

    def _count(self, gram: str) -> float:
        code, rest = _code(gram), LETTER_BITS * (ORDER - len(gram))
        lo, hi = np.searchsorted(self.codes, np.array([code << rest, code + 1 << rest], np.int32))
        return float(self.sums[hi] - self.sums[lo])

    def log_p(self, context: str, letter: str) -> float:
        """Log probability of a letter (or a word's end, a space) after up to ORDER - 1 others."""
        gram = context + letter
        found = self.known.get(gram)
        if found is None:
            p = (self._count(letter) + 0.1) / self.total
            for k in range(1, len(context) + 1):
                own = context[-k:]
                p = (self._count(own + letter) + BACKOFF * p) / (self._count(own) + BACKOFF)
            if len(self.known) >= CACHE:
                self.known.clear()
            found = self.known[gram] = float(np.log(p))
        return found

    def decode(self, text: str) -> str:
        found = self.readings.get(text)
        if found is None:
            if len(self.readings) >= CACHE:
                self.readings.clear()
            found = self.readings[text] = self._decode(text.lower())
        return found

    def _decode(self, text: str) -> str:
        # Context of the last letters: best score so far, and the reading as a chain.
        states: dict[str, tuple[float, tuple]] = {" ": (0.0, ())}
        before = ""
        first, last = len(text) - len(text.lstrip(OUTER)), len(text.rstrip(OUTER))
        for k, c in enumerate(text):
            options: list[tuple[str, float]] = []
            if c.isalpha():
                options.append((c, 0.0))
            elif c in LOOKS_LIKE:
                options += [(letter, SWAP) for letter in LOOKS_LIKE[c]]
                options.append((" ", KEEP if first <= k < last else 0.0))
            else:
                options += [(" ", 0.0), ("", JOIN)]
            if c == before and (c.isalpha() or c in LOOKS_LIKE):
                options.append(("", HOLD))
            new: dict[str, tuple[float, tuple]] = {}
            for context, (score, chain) in states.items():
                for letter, cost in options:
                    if letter == "":
                        key, value = context, (score + cost, chain)
                    elif letter == " " == context[-1]:
                        key, value = context, (score + cost, (chain, c))
                    else:
                        key = (context + letter)[-(ORDER - 1) :]
                        value = (score + cost + self.log_p(context, letter), (chain, c if letter == " " else letter))
                    if key not in new or new[key][0] < value[0]:
                        new[key] = value
            states, before = new, c
        _, chain = max(((score + (0.0 if context[-1] == " " else self.log_p(context, " ")), chain) for context, (score, chain) in states.items()), key=lambda x: x[0])
        out = []
        while chain:
            chain, letter = chain
            out.append(letter)
        return "".join(reversed(out)).strip()


def suspicious(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last word, and start and end of text, of each run of words that may be disguised."""
    letter, sign = _LETTER[data], _SIGN[data] & ~_LETTER[data]
    # A word is without what stands around it and is no letter, digit or look-alike.
    part, place = letter | _DIGIT[data] | sign, np.arange(len(data))

    def trimmed(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hi = np.maximum(np.maximum.accumulate(np.where(part, place + 1, 0))[ends - 1], starts)
        return np.minimum(np.minimum.accumulate(np.where(part, place, len(data))[::-1])[::-1][starts], hi), hi

    begin, core = trimmed(part)
    small = _LOWER[data]
    held = np.zeros(len(data), bool)
    held[2:] = letter[2:] & (small[2:] == small[1:-1]) & (small[2:] == small[:-2]) & (data[2:] < 128)

    def count(flags: np.ndarray, lo: np.ndarray = begin, hi: np.ndarray = core) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int32)
        np.cumsum(flags, out=sums[1:])
        return sums[hi] - sums[lo]

    gap = _GAP[data]
    size, letters, signs, gaps = core - begin, count(letter), count(sign), count(gap)
    mixed = (letters > 0) & (signs > 0) & (letters + signs + count(_INNER[data]) == size) & (letters + signs >= 3)
    # Held letters: two of the three places lie inside the word too.
    runs = count(held) > 0
    runs[runs] = [len(set(data[a : b].tolist())) < b - a for a, b in zip(begin[runs], core[runs], strict=True)]
    # All letters but one held twice or more.
    opens_run = letter & ~np.r_[False, letter[:-1] & (small[1:] == small[:-1])]
    twice = (letters == size) & (size >= 6) & (2 * count(opens_run | _ON[data]) <= size + 1)
    # Characters one by one, with a run of gap signs between each two.
    points = count((letter | sign) & ~_ON[data])
    opens = gap & ~np.r_[False, gap[:-1]]
    spread = (points >= 3) & (count(opens) == points - 1) & (letters + signs + gaps == size)
    inner, upto = trimmed(part & ~_OUTER[data])
    none = inner == upto
    inner, upto = np.where(none, begin, inner), np.where(none, core, upto)
    single = (count((letter | sign) & ~_ON[data], inner, upto) == 1) & (count(letter | sign, inner, upto) == upto - inner)
    # Single letters in a row, three or more of one text; words of gap signs alone don't end a row.
    between = count(gap, starts, ends) == ends - starts
    word = np.flatnonzero(~between)
    one, own = single[word], text[word]
    first = np.flatnonzero(np.r_[True, (one[1:] != one[:-1]) | (own[1:] != own[:-1])][: len(word)])
    length = np.diff(np.r_[first, len(word)])
    rows = one[first] & (length >= 3)
    alone = np.flatnonzero((mixed | runs | twice | spread) & ~single)
    lo, hi = np.r_[alone, word[first[rows]]], np.r_[alone, word[(first + length - 1)[rows]]]
    return lo, hi, begin[lo], core[hi]


def _word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Words in small letters without signs around them, and their first 4, 5 and 6 bytes."""
    plain = _LETTER[data] | _DIGIT[data]
    place = np.arange(len(data))
    after = np.minimum.accumulate(np.where(plain, place, len(data))[::-1])[::-1]
    upto = np.maximum.accumulate(np.where(plain, place + 1, 0))
    first, last = after[starts], upto[ends - 1]
    ok = first < last
    first, last, text = first[ok], last[ok], text[ok]
    small = _LOWER[data]
    found = []
    for k, size in enumerate((0, 4, 5, 6)):
        long = last - first >= size
        a, b = first[long], last[long] if not size else first[long] + size
        found.append((words.mix(words.range_hashes(small, a, b), k + 1) >> np.uint64(64 - quality.BITS), text[long]))
    return found


_decoders: dict[int, Decoder] = {}


def _decoder(held: Broadcast) -> Decoder:
    """One decoder for each process and model."""
    key = id(held.value)
    if key not in _decoders:
        _decoders.clear()
        _decoders[key] = Decoder(held.value)
    return _decoders[key]


def features(texts: pa.Array, held: Broadcast) -> tuple[np.ndarray, np.ndarray]:
    """Features of the restored texts; see ``quality.distinct``."""
    data, bounds = words.raw(texts)
    starts, ends, text = words.split(data, bounds)
    if not len(starts):
        return quality.distinct([], len(texts))
    lo, hi, begin, end = suspicious(data, starts, ends, text)
    plain = np.ones(len(starts) + 1, np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if len(lo):
        decoder, blob = _decoder(held), data.tobytes()
        read = [decoder.decode(blob[a:b].decode(errors="replace")).encode() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        side = np.frombuffer(b" ".join(read), np.uint8)
        size = np.fromiter(map(len, read), np.int64, len(read)) + 1
        side_bounds = np.r_[0, np.cumsum(size)]
        side_bounds[-1] = len(side)
        s, e, which = words.split(side, side_bounds)
        if len(s):
            found += _word_features(side, s, e, text[lo][which])
        drop = np.zeros(len(starts) + 1, np.int64)
        np.add.at(drop, lo, 1)
        np.add.at(drop, hi + 1, -1)
        plain = np.cumsum(drop) == 0
    keep = plain[:-1].astype(bool)
    if keep.any():
        found += _word_features(data, starts[keep], ends[keep], text[keep])
    return quality.distinct(found, len(texts))


def restore(text: str, decoder: Decoder) -> str:
    """A text with its disguised words restored; the rest stays as it is."""
    data, bounds = words.raw(pa.array([text], pa.large_string()))
    starts, ends, number = words.split(data, bounds)
    if not len(starts):
        return text
    lo, hi, begin, end = suspicious(data, starts, ends, number)
    blob, out, at = data.tobytes(), [], 0
    for k in np.argsort(lo):
        a, b = int(begin[k]), int(end[k])
        out += [blob[at:a], decoder.decode(blob[a:b].decode(errors="replace")).encode()]
        at = b
    return b"".join([*out, blob[at:]]).decode(errors="replace")


def restored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``restored_text``, one row per row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(language_model(docs, text_col))
    id_type = docs.schema[id_col].dataType.simpleString()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [restore(t.as_py() or "", _decoder(held)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made, pa.string())], names=["id", "restored_text"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(texts, f"id {id_type}, restored_text string").withColumnRenamed("id", id_col)


def scores(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score``, from a model learned from ``labels`` (leave out what is not to be learned from)."""
    held = docs.sparkSession.sparkContext.broadcast(language_model(docs, text_col))
    of = partial(features, held=held)
    model = quality.train(docs, labels, label_col, id_col, text_col, of=of)
    return quality.score(docs, model, id_col, text_col, of=of)
