"""Language identification by cross-parsing entropy over suffix automata.

For each labelled language one suffix automaton holds all substrings of a sample of its texts. A text is parsed with it greedily:
the longest match from where the last one ended is a phrase, a letter the automaton does not know is a phrase by itself. The
language that needs the fewest phrases for a letter wins, ties go to the smaller name. The automata are learned once, from a
bounded sample (``SAMPLE_CHARS`` shared by the languages, but ``LANG_CHARS`` for each of them at least). Every letter of a sample is told from every other one, in any script; only what
is no letter is one symbol. Automata are step tables over their own language's letters as far as ``CELLS`` goes, those of the fewest
letters first; the others are sorted lists of their steps, so thousands of letters cost no more than the sample has.

Whole texts are parsed. To parse many letters at once with array operations, a text is cut into lanes of ``LANE`` letters that are
parsed side by side, for all languages alike; a phrase ends at a lane's end.

Defined results: ``und`` with score 0 for a null text or one without a letter, and for every text if nothing can be learned. The
score is 1 - (fewest phrases / second fewest), 1 if one language is known.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import Once, held_out

UNKNOWN = "und"
SAMPLE_CHARS = 120_000  # shared by the languages
LANG_CHARS = 30_000  # of each language, however many there are
SAMPLE_TEXTS = 64  # texts of a language, at most
TEXT_CHARS = 20_000  # longer texts are not learned from
CELLS = 24_000_000  # of all step tables together
LANE = 1024
_LETTER = re.compile(r"[^\W\d_]").search


def automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``text`` (letters as numbers): of each state, letter -> state."""
    nxt: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in text.tolist():
        now = len(nxt)
        nxt.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = now
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if size[q] == size[p] + 1:
                link[now] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    return nxt


class Automata:
    """All languages' automata: a step is 2 * next place + (1 if the letter begins a phrase), a place is a state's first cell.

    A letter has one number for all languages and, in ``local``, one for each of them: its own letters come first, the last number
    is any letter it does not have. Languages in ``dense`` have their steps in ``table`` at [place + number]; those in ``sparse``
    have sorted cells, their steps, and the steps of a miss by number.
    """

    def __init__(self, samples: dict[str, str], cells: int = CELLS) -> None:
        self.names = sorted(samples)
        known = sorted(c for c in set("".join(samples.values())) if c.isalpha())
        self.classes = np.fromiter((c.isalpha() for c in map(chr, range(0x110000))), np.int32, 0x110000)
        for i, c in enumerate(known):  # 0 no letter, 1 a letter of no sample, 2.. letters of samples
            self.classes[ord(c)] = 2 + i
        self.local = np.zeros((2 + len(known), len(self.names)), np.int32)
        learned = []
        for lang, name in enumerate(self.names):
            text = self.number(samples[name])
            own = np.unique(text)
            self.local[:, lang] = len(own)
            self.local[own, lang] = np.arange(len(own))
            learned.append((len(own) + 1, automaton(self.local[text, lang])))
        self.dense, self.sparse = [], []
        tables, offset = [], 0
        self.roots = np.zeros(len(self.names), np.int64)
        for lang in sorted(range(len(learned)), key=lambda i: (learned[i][0] * len(learned[i][1]), i)):
            width, states = learned[lang]
            at = np.array([state * width + c for state, steps in enumerate(states) for c in steps], np.int64)
            to = np.array([after for steps in states for after in steps.values()], np.int64)
            missed = np.ones(width, np.int64)  # after a miss the letter begins the next phrase, if it is known at all
            missed[list(states[0])] = np.array(list(states[0].values()), np.int64) * width * 2 + 1
            if offset + width * len(states) <= cells:
                self.dense.append(lang)
                steps = np.tile((missed + 2 * offset).astype(np.int32), len(states))
                inner = at >= width  # at the root no phrase is open, so any letter begins one
                steps[at[inner]] = (offset + to[inner] * width) * 2
                tables.append(steps)
                self.roots[lang] = offset
                offset += len(steps)
            else:
                order = np.argsort(at)
                self.sparse.append((lang, at[order], to[order] * width * 2 + (at[order] < width), missed))
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)

    def number(self, text: str) -> np.ndarray:
        return self.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases that each language needs for each text: [text, language]."""
        lowered = [t.lower() for t in texts]
        sizes = np.array([len(t) for t in lowered], np.int64)
        codes = self.number("".join(lowered))
        lanes = -(-sizes // LANE)
        owner = np.repeat(np.arange(len(texts)), lanes)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = np.repeat(np.cumsum(sizes) - sizes, lanes) + nth * LANE
        length = np.minimum(LANE, sizes[owner] - nth * LANE)
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        active = np.searchsorted(-length, -np.arange(LANE), side="left")  # lanes longer than t
        longest = int(length[0]) if len(length) else 0
        count = np.zeros((len(order), len(self.names)), np.int32)
        if self.dense:
            local = np.ascontiguousarray(self.local[:, self.dense])
            state = np.tile(self.roots[self.dense].astype(np.int32), (len(order), 1))
            began = np.zeros(state.shape, np.int32)
            for t in range(longest):
                n = active[t]
                at = local[codes[begin[:n] + t]]
                at += state[:n]
                step = self.table[at]
                began[:n] += step & 1
                np.right_shift(step, 1, out=state[:n])
            count[:, self.dense] = began
        for lang, cells, steps, missed in self.sparse:
            local = self.local[:, lang].astype(np.int64)
            state = np.zeros(len(order), np.int64)
            for t in range(longest):
                n = active[t]
                letter = local[codes[begin[:n] + t]]
                cell = state[:n] + letter
                found = np.minimum(np.searchsorted(cells, cell), len(cells) - 1)
                step = np.where(cells[found] == cell, steps[found], missed[letter])
                count[:n, lang] += step & 1
                state[:n] = step >> 1
        total = np.zeros((len(texts), len(self.names)), np.int64)
        np.add.at(total, owner[order], count)
        return total


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """A sample text for each language: at most SAMPLE_TEXTS texts in the order of a hash of the id, at most its share of ``chars`` or LANG_CHARS letters."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    rows = (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
        .where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.length("text") <= TEXT_CHARS))
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= SAMPLE_TEXTS)
        .orderBy("lang", "n")
        .select("lang", "text")
        .collect()
    )
    by_lang: dict[str, list[str]] = {}
    for r in rows:
        by_lang.setdefault(r.lang, []).append(r.text.lower())
    share = max(LANG_CHARS, chars // max(1, len(by_lang)))
    return {lang: "\n".join(texts)[:share] for lang, texts in by_lang.items()}


def identify(docs: DataFrame, samples: dict[str, str], text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score. Nothing is shuffled; columns of these names are replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(Once(Automata, samples))

    @F.pandas_udf("lang_pred string, score double")
    def parse(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automata = sent.value()
        for texts in parts:
            names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            able = [i for i, t in enumerate(texts) if t and _LETTER(t)] if automata.names else []
            if able:
                counts = automata.phrases([texts.iloc[i] for i in able])
                best = counts.argmin(axis=1)
                two = np.sort(counts, axis=1)[:, :2]
                names[able] = np.array(automata.names, object)[best]
                scores[able] = 1 - two[:, 0] / two[:, 1] if two.shape[1] > 1 else 1.0
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.withColumn("_lang", parse(F.col(text_col))).withColumns({"lang_pred": F.col("_lang.lang_pred"), "score": F.col("_lang.score")}).drop("_lang")
