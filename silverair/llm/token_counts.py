"""Token counts by finite-state transducers compiled from a byte-level BPE tokenizer.

Two deterministic transducers replace the tokenizer. The first reads characters
and marks where pre-tokens begin. It has a few states, so a chunk of text is a map
from every state to its end state; maps of chunks compose, and a parallel prefix
scan gives the state that each chunk starts in. The second reads the bytes of one
pre-token; its transitions carry the tokens that a byte adds to the count. It is
back in its first state at every mark, so its chunks compose by adding counts.

A state of the second holds the places in which a token may have begun that is not
over yet, each with the last token of the encoding that ends there and its count.
The encoding of a text that ends in a byte ends in the one token that fits the
encoding before it (Berglund and van der Merwe, 2023), so the next state needs no
more. There are finitely many states; those that texts reach are compiled when
they are first reached.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from silverair.llm.batches import map_texts

# Kinds of characters. Letters that occur in contractions have kinds of their own.
SPACE, BLANK, LETTER, SHORT, R, V, L, E, NUMBER, OTHER, QUOTE, END = range(12)
LETTERS = {"s": SHORT, "t": SHORT, "m": SHORT, "d": SHORT, "r": R, "v": V, "l": L, "e": E}
CHUNK = 64
# Pre-tokens and transitions that a task keeps. They bound memory only.
TABLE_ENTRIES = 600_000
WORDS = 500_000


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of the vocabulary stands for: visible ones for themselves, others from 256 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = sorted(set(range(256)) - set(visible))
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def character_kinds(pieces_of: Callable[[str], list]) -> np.ndarray:
    """Kind of every code point, as the tokenizer's own splitter tells letters, numbers, blanks and others apart.

    ``pieces_of`` splits a text. Characters of one assumed kind form a single
    piece, so one call per kind finds those that the splitter knows otherwise.
    """

    def probed(char: str) -> int:
        kinds = (("a", LETTER), ("1", NUMBER), ("!", OTHER))
        return next((kind for before, kind in kinds if len(pieces_of(before + char)) == 1), BLANK)

    kinds = np.full(0x110000, OTHER, np.uint8)
    assumed: dict[int, list[str]] = {LETTER: [], NUMBER: [], OTHER: [], BLANK: []}
    for char in map(chr, range(0x110000)):
        category = unicodedata.category(char)
        if category == "Cs" or char in " '":
            continue
        blank = category[0] == "Z" or (category == "Cc" and char.isspace())
        assumed[BLANK if blank else LETTER if category[0] == "L" else NUMBER if category[0] == "N" else OTHER].append(char)
    for kind, chars in assumed.items():
        if kind == BLANK:
            for char in chars:
                kinds[ord(char)] = probed(char)
            continue
        for _, (low, high) in pieces_of("".join(chars)):
            kinds[[ord(c) for c in chars[low:high]]] = probed(chars[low])
    kinds[ord(" ")], kinds[ord("'")] = SPACE, QUOTE
    for char, kind in LETTERS.items():
        kinds[ord(char)] = kind
    return kinds


def boundary_transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks by state and kind: bit 0, a pre-token begins here; bit 1, one began a character before.

    Contractions and the last blank of a run are decided a character late.
    """
    names = ["begin", "letters", "numbers", "others", "quote", "quote r or v", "quote l", "space", "spaces", "blank", "blanks"]
    state = {name: i for i, name in enumerate(names)}
    letters = (LETTER, SHORT, R, V, L, E)
    opens = {k: "letters" for k in letters}
    opens |= {NUMBER: "numbers", OTHER: "others", QUOTE: "quote", SPACE: "space", BLANK: "blank", END: "begin"}
    # A space goes with what follows it, so an apostrophe behind it opens no contraction.
    joins = opens | {QUOTE: "others"}
    after = np.zeros((len(names), END + 1), np.uint8)
    marks = np.zeros((len(names), END + 1), np.uint8)
    for kind in range(END + 1):
        wide = kind in (SPACE, BLANK)
        run = "spaces" if kind == SPACE else "blanks"
        rule = {name: (opens[kind], 1) for name in names}
        if kind in letters:
            rule["letters"] = ("letters", 0)
        if kind == NUMBER:
            rule["numbers"] = ("numbers", 0)
        if kind in (OTHER, QUOTE):
            rule["others"] = rule["quote"] = ("others", 0)
        # A contraction is over with its last letter: what follows begins anew.
        late = {SHORT: "begin", R: "quote r or v", V: "quote r or v", L: "quote l"}
        if kind in late:
            rule["quote"] = (late[kind], 0)
        for name, last in (("quote r or v", E), ("quote l", L)):
            # Without its last letter it is no contraction: the letter before began a pre-token.
            rule[name] = ("begin", 0) if kind == last else (opens[kind], 2 if kind in letters else 3)
        if wide:
            for name in ("space", "spaces", "blank", "blanks"):
                rule[name] = (run, 0)
        elif kind != END:
            rule["space"] = (joins[kind], 0)
            rule["spaces"] = (joins[kind], 2)
            rule["blanks"] = (opens[kind], 3)
        for name, (target, mark) in rule.items():
            after[state[name], kind], marks[state[name], kind] = state[target], mark
    return after, marks


AFTER, MARKS = boundary_transducer()


def starts(kinds: np.ndarray) -> np.ndarray:
    """Positions where pre-tokens begin; each END is one. ``kinds`` ends with END."""
    states, width = AFTER.shape
    chunks = -(-len(kinds) // CHUNK)
    # A state stands as the offset of its row.
    after, marks = AFTER.ravel().astype(np.uint16) * width, MARKS.ravel()
    padded = np.full(chunks * CHUNK, END, np.uint8)
    padded[: len(kinds)] = kinds
    columns = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    # The map of each chunk: its end state for every state that it may start in.
    maps = np.broadcast_to(np.arange(states, dtype=np.uint16) * width, (chunks, states))
    for column in columns:
        maps = after.take(maps + column[:, None])
    maps //= width
    # Maps of more and more chunks, doubling: afterwards row i covers chunks 0 to i.
    step = 1
    while step < chunks:
        maps = np.concatenate([maps[:step], np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), axis=1)])
        step *= 2
    state = np.zeros(chunks, np.uint16)
    state[1:] = maps[:-1, 0] * width
    found = np.empty((CHUNK, chunks), np.uint8)
    for i, column in enumerate(columns):
        place = state + column
        found[i], state = marks.take(place), after.take(place)
    marked = found.T.reshape(-1)[: len(kinds)]
    here = (marked & 1).astype(bool)
    here[:-1] |= (marked[1:] & 2).astype(bool)
    return np.flatnonzero(here)


@dataclass(frozen=True)
class Vocabulary:
    """A compiled tokenizer: kinds of characters, merges and special strings. Bytes have ids 0 to 255, merge i has 256 + i."""

    kinds: np.ndarray
    merges: list[tuple[int, int]]
    special: list[str]

    @classmethod
    @cache
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        bare = not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        known = splitter["type"] == "ByteLevel" and splitter["use_regex"] and not splitter["add_prefix_space"]
        if model["type"] != "BPE" or spec["normalizer"] or not (plain and bare and known):
            raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
        alphabet = byte_alphabet()
        ids = {bytes([b]): b for b in range(256)}
        merges = []
        for pair in model["merges"]:
            left, right = (bytes(alphabet[c] for c in part) for part in (pair.split(" ") if isinstance(pair, str) else pair))
            merges.append((ids[left], ids[right]))
            if left + right in ids:
                raise ValueError("a token has two merges")
            ids[left + right] = 255 + len(merges)
        library = Tokenizer.from_file(path).pre_tokenizer
        return cls(character_kinds(library.pre_tokenize_str), merges, [t["content"] for t in spec["added_tokens"]])


class PieceTransducer:
    """Counts the tokens of a pre-token byte by byte."""

    def __init__(self, merges: list[tuple[int, int]]) -> None:
        self.merges = merges
        self.merged = {pair: 256 + i for i, pair in enumerate(merges)}
        spelled = [bytes([b]) for b in range(256)]
        for left, right in merges:
            spelled.append(spelled[left] + spelled[right])
        # For each text that a token is or begins with: the token's id, or -1, and whether a longer one begins so.
        longer = {text[:n] for text in spelled for n in range(1, len(text))}
        self.texts = dict.fromkeys(longer, (-1, True)) | {text: (i, text in longer) for i, text in enumerate(spelled)}
        self.fitting: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        # The first state: nothing read; a token may begin here, behind no other.
        self.states = [(b"", ((0, -1, 0),))]
        self.numbers = {self.states[0]: 0}
        self.table: dict[int, tuple[int, int]] = {}

    def edge(self, token: int, side: int) -> Iterator[tuple[int, int]]:
        """Tokens on the right (1) or left (0) edge of ``token``, with the merge that uses each up."""
        used = 256 + len(self.merges)
        while True:
            yield token, used
            if token < 256:
                return
            used, token = token, self.merges[token - 256][side]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart, that is, no merge across the border comes before those that use up its parts.

        Of equal merges the left one comes first, so a part on the left is gone by then.
        """
        key = (left, right)
        if key not in self.fitting:
            ends = list(self.edge(right, 0))
            self.fitting[key] = not any(
                (across := self.merged.get((a, b))) is not None and across < a_used and across <= b_used
                for a, a_used in self.edge(left, 1)
                for b, b_used in ends
            )
        return self.fitting[key]

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition from ``state`` under ``byte``: next state, and the tokens that it adds."""
        suffix, open_places = self.states[state]
        text = suffix + bytes([byte])
        size, found, kept = len(text), None, []
        for length, before, count in open_places:
            token, longer = self.texts.get(text[size - length - 1 :], (-1, False))
            if token >= 0 and found is None and (before < 0 or self.fits(before, token)):
                found, added = token, count + 1
            if longer:
                kept.append((length + 1, before, count))
        if found is None:
            raise ValueError("the vocabulary lacks a byte")
        places = (*((n, t, c - added) for n, t, c in kept), (0, found, 0))
        kept = (text[size - places[0][0] :], places)
        number = self.numbers.setdefault(kept, len(self.states))
        if number == len(self.states):
            self.states.append(kept)
        self.table[state << 8 | byte] = number, added
        return number, added

    def count(self, piece: bytes) -> int:
        if len(self.table) > TABLE_ENTRIES:
            self.clear()
        known, state, total = self.table.get, 0, 0
        for byte in piece:
            state, added = known(state << 8 | byte) or self.compile(state, byte)
            total += added
        return total


class TokenCounter:
    """Numbers of tokens of texts."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.kinds = vocabulary.kinds
        self.pieces = PieceTransducer(vocabulary.merges)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.known: dict[str, int] = {}

    def learn(self, pieces: set[str]) -> None:
        """Count the pre-tokens that are not known yet."""
        if len(self.known) > TABLE_ENTRIES:
            self.known.clear()
        for piece in pieces - self.known.keys():
            self.known[piece] = self.pieces.count(piece.encode())

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        parts = [self.special.split(t) if self.special else [t] for t in texts]
        totals = np.array([len(p) - 1 for p in parts], np.int64)
        # Every part ends in an END, which no pre-token crosses.
        joined = "".join(f"{part}\0" for text in parts for part in text)
        ends = np.cumsum([len(part) + 1 for text in parts for part in text], dtype=np.int64) - 1
        owners = np.repeat(np.arange(len(texts)), (totals + 1))
        kinds = self.kinds[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        kinds[ends] = END
        begins = starts(kinds)
        behind = np.append(begins[1:], len(kinds))
        own = kinds[begins] != END
        begins, behind = begins[own], behind[own]
        owner = owners[np.searchsorted(ends, begins)]
        for at in range(0, len(begins), WORDS):
            cut = slice(at, at + WORDS)
            pieces = [joined[a:b] for a, b in zip(begins[cut].tolist(), behind[cut].tolist(), strict=True)]
            self.learn(set(pieces))
            counts = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
            np.add.at(totals, owner[cut], counts)
        return [totals]


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int = 512, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every row.

    Counts equal those of the library for the whole text, without tokens added
    around it; its special strings count as one token each. A null text counts as
    empty: no bytes, no tokens. Ids may be null or repeat; repeated rows give
    repeated results, an empty table an empty one. Texts are worked on where they
    are read, nothing is shuffled. Very long ones take some 20 bytes a character.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(tokenizer_path))
    counted = map_texts(
        docs.withColumn("token_bytes", F.coalesce(F.octet_length(F.col(text_column)), F.lit(0)).cast("long")),
        id_column,
        text_column,
        "n_tokens long",
        lambda: TokenCounter(vocabulary.value),
        carry=[id_column, "token_bytes"],
    )
    return counted.select(
        id_column, F.col("token_bytes").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
