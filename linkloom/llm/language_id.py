"""Language identification by cross-parsing entropy.

For every language a suffix automaton holds a bounded sample of its labelled text. A text is parsed against each: from
where it stands, the longest match in the automaton is one phrase, then the next begins. Few phrases per character mean
that the text is made of pieces the sample has, so the language that needs the fewest bits in phrases wins.

Every labelled language has an automaton, and every letter of its sample counts as itself. A language's commonest letters
have dense columns of transitions, its other letters are looked up, so a script of thousands of letters costs no more
memory than another. Automata are built once, by the driver, and told as lists of transitions; dense tables that don't fit
beside each other are made one after the other, so memory doesn't grow with the number of languages.

Parsing runs over many pieces of texts at once, a character a step. Pieces are of fixed length, so the result doesn't depend
on how rows come in batches, and no length is special.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import reachable, release

#: Of the sample: documents and characters a language.
DOCS_PER_LANGUAGE, CHARS_PER_LANGUAGE = 48, 30_000
#: Characters that a piece holds; letters of a language with a dense column.
PIECE, LETTERS = 256, 62
#: Characters of pieces that are parsed together; cells of dense tables that a task keeps.
LANES_CHARS, CELLS = 1 << 20, 1 << 24
UNKNOWN = "und"


def letters_only(text: str) -> str:
    """Lower case, each run of other characters than letters one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(text: list[int]) -> tuple[int, np.ndarray]:
    """Number of states of the suffix automaton of ``text``, and its transitions (state, letter, target). State 0 is the start; no transition leads there."""
    link, length, moves = [-1], [0], [{}]
    last = 0
    for c in text:
        new = len(link)
        link.append(0)
        length.append(length[last] + 1)
        moves.append({})
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                moves.append(dict(moves[q]))
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return len(link), np.array([(s, c, t) for s, m in enumerate(moves) for c, t in m.items()], dtype=np.int32).reshape(-1, 3)


class Automaton:
    """A language's suffix automaton over the letters of all samples: transitions of common letters, which become dense columns, and of the others."""

    def __init__(self, text: np.ndarray, letters: int):
        self.chars = len(text)
        self.states, moves = suffix_automaton(text.tolist())
        counts = np.bincount(text, minlength=letters + 2)
        counts[0] = 0
        own = np.argsort(-counts, kind="stable")[: min(LETTERS, int((counts > 0).sum()))]
        #: Of each letter: its column; then one for letters that are looked up, and one for letters that the sample hasn't.
        self.rare, self.width = len(own) + 1, len(own) + 3
        self.columns = np.where(counts > 0, self.rare, self.rare + 1).astype(np.uint8)
        self.columns[own] = np.arange(1, len(own) + 1)
        self.columns[0] = 0
        column = self.columns[moves[:, 1]]
        self.common = np.stack([moves[:, 0] * self.width + column, moves[:, 2] * self.width])[:, column != self.rare]
        other = moves[column == self.rare].astype(np.int64)
        key = other[:, 0] * (letters + 2) + other[:, 1]
        order = np.argsort(key)
        self.letters, self.keys, self.targets = letters, key[order], (other[:, 2] * self.width)[order].astype(np.int32)

    def cells(self) -> int:
        return self.states * self.width

    def table(self) -> np.ndarray:
        """Dense transitions; a state is addressed by its first cell, and 0 as a target means none."""
        out = np.zeros(self.cells(), dtype=np.int32)
        out[self.common[0]] = self.common[1]
        return out

    def looked_up(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Targets of letters that have no column."""
        key = states.astype(np.int64) // self.width * (self.letters + 2) + letters
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], 0)


class Parser:
    """Suffix automata of all languages."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        self.alphabet = sorted(set("".join(samples.values())) - {" "})
        self.made: dict[int, np.ndarray] = {}
        self._code = None
        self.automata = [Automaton(self.codes(samples[x]), len(self.alphabet)) for x in self.languages]
        self.bits = np.array([math.log2(max(2, len(samples[x]))) for x in self.languages])

    def __getstate__(self):
        return self.__dict__ | {"made": {}, "_code": None}  # workers make their own

    def code(self) -> np.ndarray:
        """Of each code point: 0 for anything but a letter, the letter's number, or one number for letters that no sample has."""
        if self._code is None:
            unknown = len(self.alphabet) + 1
            code = np.zeros(0x110000, dtype=np.uint8 if unknown < 256 else np.uint32)
            code[np.fromiter((chr(k).isalpha() for k in range(0x110000)), dtype=bool, count=0x110000)] = unknown
            for k, c in enumerate(self.alphabet):
                code[ord(c)] = 1 + k
            self._code = code
        return self._code

    def codes(self, text: str) -> np.ndarray:
        """Letters' codes; runs of other characters are one 0, none at the ends."""
        c = self.code()[np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")]
        keep = c != 0
        keep[1:] |= c[:-1] != 0
        c = c[keep]
        return c[: len(c) - 1] if len(c) and c[-1] == 0 else c

    def table(self, k: int) -> np.ndarray:
        """A language's dense table; as many as fit are kept."""
        if k in self.made:
            return self.made[k]
        table = self.automata[k].table()
        if sum(map(len, self.made.values())) + len(table) <= CELLS:
            self.made[k] = table
        return table

    def phrases(self, pieces: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each piece (columns, longest first) in each language."""
        out = np.zeros((len(self.automata), pieces.shape[1]), dtype=np.int32)
        live = np.searchsorted(-lengths, -np.arange(pieces.shape[0]), side="left")  # pieces longer than each step
        for k, own in enumerate(self.automata):
            table, columns = self.table(k), own.columns[pieces]
            rare = (columns == own.rare).any(axis=1) & (len(own.keys) > 0)
            root, state, count = table[: own.width], np.zeros(pieces.shape[1], np.int32), out[k]
            count += lengths > 0
            for t in range(pieces.shape[0]):
                if not (n := int(live[t])):
                    break
                c = columns[t, :n]
                to = table[state[:n] + c]
                if rare[t]:
                    where = np.flatnonzero(c == own.rare)
                    to[where] = own.looked_up(state[where], pieces[t, where])
                ends = to == 0
                if t:  # a letter that the sample hasn't leaves the start state, and is a phrase of its own
                    count[:n] += ends | (state[:n] == 0)
                np.copyto(to, root[c], where=ends)
                if rare[t]:
                    where = where[ends[where]]
                    to[where] = own.looked_up(np.zeros(len(where), np.int32), pieces[t, where])
                state[:n] = to
        return out

    def parse(self, texts: Iterator[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text in each language, and each text's parsed characters."""
        total, chars = [], []
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush():
            counts = np.zeros((len(chars), len(self.automata)), np.int64)
            if held:
                lengths = np.array([len(c) for _, c in held])
                order = np.argsort(-lengths, kind="stable")
                matrix = np.zeros((int(lengths.max()), len(held)), dtype=self.code().dtype)
                for column, k in enumerate(order):
                    matrix[: lengths[k], column] = held[k][1]
                got = self.phrases(matrix, lengths[order])
                owner = np.array([held[k][0] for k in order])
                for k in range(len(self.automata)):
                    np.add.at(counts[:, k], owner, got[k])
            total.append(counts)

        for row, text in enumerate(texts):
            c = self.codes(text or "")
            chars.append(len(c))
            for first in range(0, len(c), PIECE):
                held.append((row, c[first : first + PIECE]))
                size += PIECE
                if size >= LANES_CHARS:
                    flush()
                    held, size = [], 0
        flush()
        out = np.zeros((len(chars), len(self.automata)), np.int64)
        for counts in total:
            out[: len(counts)] += counts
        return out, np.array(chars, dtype=np.int64)


def language_samples(docs: DataFrame, train: Column, text_col: str, lang_col: str, id_col: str) -> dict[str, str]:
    """A bounded sample of labelled text for every language, by a hash of the id; documents of common lengths first."""
    text, lang, at = F.col(f"`{text_col}`").cast("string"), F.col(f"`{lang_col}`").cast("string"), F.col(f"`{id_col}`")
    rows = docs.filter(train & lang.isNotNull() & text.isNotNull()).select(at.alias("id"), lang.alias("lang"), F.xxhash64(text).alias("print"), F.char_length(text).between(200, 6000).alias("common"))
    order = Window.partitionBy("lang").orderBy(F.desc("common"), F.xxhash64("id"), "id", "print")
    chosen = rows.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= DOCS_PER_LANGUAGE).groupBy("id", "lang", "print").agg(F.min("k").alias("k"))
    # At most DOCS_PER_LANGUAGE rows of four short columns a language: its size is that of the set of languages.
    own = docs.select(at.alias("id"), lang.alias("lang"), F.xxhash64(text).alias("print"), F.substring(text, 1, CHARS_PER_LANGUAGE).alias("text"))
    same = own["id"].eqNullSafe(chosen["id"]) & (own["lang"] == chosen["lang"]) & (own["print"] == chosen["print"])
    found: dict[str, list] = {}
    for r in own.join(F.broadcast(chosen), same).select(own["lang"], "k", "text").groupBy("lang", "k").agg(F.min("text").alias("text")).collect():
        found.setdefault(r["lang"], []).append((r["k"], r["text"]))
    samples = {x: letters_only(" ".join(t for _, t in sorted(rows)))[:CHARS_PER_LANGUAGE] for x, rows in found.items()}
    return {x: t for x, t in sorted(samples.items()) if t}


def identify_language(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Predict the language of every whole text.

    ``train`` says which rows the sample may be drawn from. Returns the id, the columns in ``keep``, lang_pred and score:
    the share of bits that the best language saves against the second, 1 if there is only one. A text that is null or
    has no letter gets ``und`` and 0, as does every text if no row is labelled. Ties go to the first language by name.
    Repeated rows give repeated results and count once in the sample; a very long text is parsed in pieces and costs time by
    its length; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    samples = language_samples(docs, train, text_col, lang_col, id_col)
    told = docs.sparkSession.sparkContext.broadcast(Parser(samples)) if samples else None  # transitions, about 1 MB a language

    def parsed(parser: Parser | None, column: pa.Array) -> pa.Array:
        if parser is None:
            best, score = [UNKNOWN] * len(column), np.zeros(len(column))
        else:
            phrases, chars = parser.parse(t.as_py() for t in column)
            bits = phrases * parser.bits
            ranked = np.sort(bits, axis=1)
            second = ranked[:, 1] if ranked.shape[1] > 1 else np.full(len(column), np.inf)
            with np.errstate(invalid="ignore", divide="ignore"):
                saved = np.where(np.isinf(second), 1.0, (second - ranked[:, 0]) / second)
            best = [parser.languages[k] if n else UNKNOWN for k, n in zip(np.argmin(bits, axis=1), chars, strict=True)]
            score = np.where(chars > 0, np.clip(saved, 0, 1), 0.0)
        return pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(score, pa.float64())], names=["lang_pred", "score"])

    @F.arrow_udf("lang_pred string, score double")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parser = told.value if told else None
        for column in columns:
            yield parsed(parser, column)
        if parser:
            parser.made.clear()
        release()

    # Only texts go to Python; all other columns stay in Spark.
    rows = reachable(docs).select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate([id_col, *keep])], predict(F.col(f"`{text_col}`").cast("string")).alias("x"))
    return rows.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate([id_col, *keep])], "x.lang_pred", "x.score")
