"""Language identification of mixed-language text.

A word is a maximal run of letters. Its script, found by code-point ranges, narrows the languages
to those that use the script in the training text. Each candidate scores the word by its
letter trigrams, and a Viterbi pass with a penalty for each switch labels every word, so that
runs of equal labels are the spans of the text.

Defined cases: a null text, or one without letters, is `und` with score 0 and no spans. With no
training rows at all every text is `und`. Ties between languages go to the first in sorted order.
A word in a script that no learned language uses is neutral: all languages stay candidates with
equal scores. Training rows without text or language are skipped. Repeated rows each get a result.
Columns of the input other than the text are passed on; result names that they already use get
trailing underscores (`common.appended`).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import appended

UND = "und"
BUCKETS = 1 << 16
SWITCH_PENALTY = 16.0
#: Share of a language's training letters that a script needs to count as used by it.
SCRIPT_SHARE = 0.01
#: Rate that stands for trigrams a language has not shown.
FLOOR = 1e-6
#: Letters handled at once, so that memory does not follow the length of a text.
PIECE = 1 << 20

# Scripts and the first and last code points of their Unicode blocks.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "ethiopic": [(0x1200, 0x137F)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)],
}
SCRIPT_NAMES = list(SCRIPTS)


class Alphabet:
    """Per code point: its script (0 for none, for letters only) and its lower-case form."""

    _made: "Alphabet | None" = None

    def __init__(self):
        points = range(0x110000)
        letters = np.fromiter((chr(p).isalpha() for p in points), bool, 0x110000)
        self.script = np.zeros(0x110000, np.int8)
        for number, name in enumerate(SCRIPT_NAMES, 1):
            for first, last in SCRIPTS[name]:
                self.script[first : last + 1] = number
        self.script[~letters] = -1
        self.lower = np.arange(0x110000, dtype=np.uint32)
        for point in np.flatnonzero(letters):
            low = chr(point).lower()
            if len(low) == 1:
                self.lower[point] = ord(low)
        self.lower[~letters] = 0

    @classmethod
    def get(cls) -> "Alphabet":
        if cls._made is None:
            cls._made = cls()
        return cls._made


def _pieces(text: str):
    """Parts of at most about PIECE characters that do not cut a word, unless it is longer."""
    start = 0
    while start < len(text):
        end = min(len(text), start + PIECE)
        cut = end
        while end < len(text) and cut > start and text[cut - 1].isalpha():
            cut -= 1
        cut = cut if cut > start else end
        yield text[start:cut]
        start = cut


def _letters(text: str):
    """Of the letters: trigram buckets and scripts; and where words begin among them."""
    alphabet = Alphabet.get()
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    low = np.zeros(len(points) + 2, np.uint32)
    low[1:-1] = alphabet.lower[points]
    at = np.flatnonzero(low)
    hashed = (
        low[at - 1] * np.uint32(0x9E3779B1) + low[at] * np.uint32(0x85EBCA77)
    ) ^ low[at + 1] * np.uint32(0xC2B2AE3D)
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x2C1B3C6D)
    first = np.flatnonzero(low[at - 1] == 0)
    return hashed >> np.uint32(16), alphabet.script[points[at - 1]], first


@dataclass
class Model:
    langs: list[str]
    #: log rate of each trigram bucket, one column per language
    rates: np.ndarray
    #: whether a language uses a script
    uses: np.ndarray

    def word_scores(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Scores of each word by language, and the letters of each word."""
        return self._words(text)[:2]

    def _words(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores, letters, and letters in scripts that no language uses, of each word."""
        strange = ~self.uses.any(axis=1)
        scores, sizes, others = [], [], []
        for piece in _pieces(text):
            buckets, scripts, first = _letters(piece)
            if len(first) == 0:
                continue
            found = np.add.reduceat(self.rates[buckets], first, axis=0)
            allowed = self.uses[scripts[first]]
            known = allowed.any(axis=1)
            found[~known] = 0.0
            found[known[:, None] & ~allowed] = -1e9
            scores.append(found)
            sizes.append(np.diff(first, append=len(buckets)))
            others.append(np.add.reduceat(strange[scripts].astype(np.int64), first))
        if not scores:
            return np.zeros((0, len(self.langs))), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(scores), np.concatenate(sizes), np.concatenate(others)

    def label(self, text: str | None, penalty: float):
        """(language, score, labels, letters): a label for each word."""
        return self.label_with_shares(text, penalty)[:4]

    def label_with_shares(self, text: str | None, penalty: float):
        """As `label`; and the shares of the letters in spans of that language and in a script of some
        language, and of the letters in other scripts."""
        scores, sizes, strange = self._words(text or "")
        if len(scores) == 0 or not self.langs:
            return UND, 0.0, np.zeros(0, np.int64), sizes, 0.0, 0.0
        labels = best_path(scores, penalty)
        letters = np.bincount(labels, weights=sizes, minlength=len(self.langs))
        best = int(letters.argmax())
        own = float((sizes - strange)[labels == best].sum() / letters.sum())
        other = float(strange.sum() / letters.sum())
        return self.langs[best], float(letters[best] / letters.sum()), labels, sizes, own, other


def best_path(scores: np.ndarray, penalty: float) -> np.ndarray:
    """Labels of the words with the highest sum of scores less `penalty` for each switch.

    One label throughout is best when no other label gains `penalty` or more over any stretch of
    words, since a stretch of other labels has at least as many switches as labels. That test
    is a running maximum; only the remaining texts need the step-by-step recursion.
    """
    total = scores.sum(axis=0)
    best = int(total.argmax())
    lead = np.cumsum(scores[:, [best]] - scores, axis=0)
    highest = np.maximum(np.maximum.accumulate(lead, axis=0), 0.0)
    if (highest - lead).max() < penalty:
        return np.full(len(scores), best)
    value = scores[0].copy()
    back = np.empty(scores.shape, np.int32)
    own = np.arange(scores.shape[1], dtype=np.int32)
    for t in range(1, len(scores)):
        top = value.argmax()
        switched = value[top] - penalty
        stay = value >= switched
        back[t] = np.where(stay, own, top)
        value = np.where(stay, value, switched) + scores[t]
    labels = np.empty(len(scores), np.int64)
    labels[-1] = value.argmax()
    for t in range(len(scores) - 1, 0, -1):
        labels[t - 1] = back[t][labels[t]]
    return labels


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Trigram and script counts of every language over all rows that have text and language.

    Counts are added up in each task before the shuffle. The model has BUCKETS rates for each
    language, so its size depends on the number of languages alone.
    """

    def count(batches):
        held: dict[str, list] = {}
        sums: dict[str, tuple] = {}

        def add(name):
            buckets, scripts = (np.concatenate(x) for x in zip(*held.pop(name)))
            seen = sums.setdefault(name, (np.zeros(BUCKETS, np.int64), np.zeros(32, np.int64)))
            seen[0][:] += np.bincount(buckets, minlength=BUCKETS)
            seen[1][:] += np.bincount(scripts, minlength=32)

        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for value, name in zip(texts, langs):
                for piece in _pieces(value):
                    buckets, scripts, _ = _letters(piece)
                    held.setdefault(name, []).append((buckets, scripts))
                    if sum(len(x[0]) for x in held[name][-1:]) >= PIECE or len(held[name]) >= 64:
                        add(name)
        for name in list(held):
            add(name)
        for name, (buckets, scripts) in sums.items():
            keys = np.flatnonzero(buckets)
            used = np.flatnonzero(scripts)
            yield pa.RecordBatch.from_pydict(
                {
                    "name": [name] * (len(keys) + len(used)),
                    "slot": np.concatenate([keys, -1 - used]).astype(np.int32),
                    "n": np.concatenate([buckets[keys], scripts[used]]),
                }
            )

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    counted = (
        rows.mapInArrow(count, "name string, slot int, n long")
        .groupBy("name", "slot")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names, slots, n = (counted.column(i).to_pylist() for i in range(3))
    langs = sorted(set(names))
    number = {name: i for i, name in enumerate(langs)}
    trigrams = np.zeros((BUCKETS, len(langs)))
    scripts = np.zeros((32, len(langs)))
    for name, slot, value in zip(names, slots, n):
        (trigrams[slot] if slot >= 0 else scripts[-1 - slot])[number[name]] = value
    rates = np.log(trigrams / np.maximum(trigrams.sum(axis=0), 1) + FLOOR)
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    uses = share >= SCRIPT_SHARE
    uses[0] = False
    return Model(langs, rates, uses)


def identify(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    penalty: float = SWITCH_PENALTY,
    shares: bool = False,
) -> DataFrame:
    """`docs` with `lang_pred`, `score` (share of the letters in spans of that language) and
    `spans`: language, first word, number of words and letters of each run, in order. With `shares`
    also `own_share`, the score without letters in scripts that no learned language uses, and
    `strange_share`, the share of these letters."""
    span = "struct<lang:string,first_word:int,words:int,letters:long>"
    wanted = {"lang_pred": "string", "score": "double", "spans": f"array<{span}>"}
    if shares:
        wanted |= {"own_share": "double", "strange_share": "double"}
    names, schema = appended(docs, wanted)
    at = docs.columns.index(text)
    spans_type = pa.list_(
        pa.struct(
            [
                ("lang", pa.string()),
                ("first_word", pa.int32()),
                ("words", pa.int32()),
                ("letters", pa.int64()),
            ]
        )
    )

    def spans_of(labels, sizes):
        if len(labels) == 0:
            return []
        first = np.flatnonzero(np.diff(labels, prepend=-1))
        words = np.diff(first, append=len(labels))
        letters = np.add.reduceat(sizes, first)
        return [
            {"lang": model.langs[labels[f]], "first_word": f, "words": w, "letters": n}
            for f, w, n in zip(first.tolist(), words.tolist(), letters.tolist())
        ]

    def run(batches):
        for batch in batches:
            langs, scores, spans, own, strange = [], [], [], [], []
            for value in batch.column(at).to_pylist():
                name, score, labels, sizes, *both = model.label_with_shares(value, penalty)
                own.append(both[0])
                strange.append(both[1])
                langs.append(name)
                scores.append(score)
                spans.append(spans_of(labels, sizes))
            made = [
                pa.array(langs, pa.string()),
                pa.array(scores, pa.float64()),
                pa.array(spans, spans_type),
            ]
            if shares:
                made += [pa.array(own, pa.float64()), pa.array(strange, pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made], names=[*batch.schema.names, *names]
            )

    return docs.mapInArrow(run, schema)
