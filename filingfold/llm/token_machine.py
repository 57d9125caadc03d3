"""Token counts by a finite-state machine compiled from a tokenizer.

The tokenizer is byte-pair encoding with word ends: the text is normalised (NFC, white
space to blanks, lower case), cut into words (letters, one digit, other signs, English
contractions) and each word's bytes are merged in the order of the merge list.  All that
after normalisation becomes one deterministic transducer over bytes.  Each transition
carries the tokens it emits: the count of the text read so far, were it to end here,
less the same before, so the emissions of a text add up to its token count.

Two facts make the states finite.  The tokens of a word are those of the word without
its last token, then that token; and a split is the tokenizer's if each two neighbours
stay apart when merged alone.  So the last token of every prefix follows from the last
tokens at the few earlier places where some token may still have begun, and a state is
those places with their tokens and relative counts.  States and transitions are made when
a text first needs them, kept for later texts, and dropped when there are too many (only
those in use stay), so the table is bounded and the counts are the same.

A run of texts is cut into chunks of 64 bytes, which step side by side.  A chunk's state
map is found from a holding state that waits for the first blank: behind it the state
no longer depends on what came before, so the map is constant; a chunk without a blank
leaves the state open.  Maps compose (the right one, unless it is open), so a prefix scan
gives each chunk the state it starts in, and the bytes up to its first blank follow.  An
open chunk is run from its start state and the scan repeated, which only words longer
than a chunk need.  A prefix sum over the emissions gives each text's count.

Defined cases: null and empty texts have no bytes and no tokens; texts are read whole;
equal rows give equal results, a row for each; an empty table gives an empty result; a
null doc_id is passed through; other columns are left out, whatever their names.
"""

from __future__ import annotations

import json
import re
import sys
import types
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingfold.llm.common import table
from filingfold.llm.textkernel import runs, text_buffers

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
CHUNK = 64
MOST_STATES = 110_000
NEVER = 1 << 40
END = "</w>"

OTHER, LETTER, DIGIT, BLANK = range(4)
#: Kinds of states: before a word, in letters, in other signs, in a digit, after an
#: apostrophe that begins a word, and after such an apostrophe with r, v or l.
HOLD, START, LETTERS, SIGNS, NUMBER, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(9)
#: Contractions that are words of their own (fixed values): one letter, or two.
SHORT = {ord("s"), ord("t"), ord("m"), ord("d")}
LONG = {ord("r"): (QUOTE_R, ord("e")), ord("v"): (QUOTE_V, ord("e")), ord("l"): (QUOTE_L, ord("l"))}
#: Input symbols: ASCII bytes, bytes that continue a character, and the bytes that begin
#: one (0xC0 to 0xFF) once for each class of the character.
SYMBOLS = 128 + 64 + 4 * 64


#: Letters and digits that Unicode 16 added and this Python's tables lack.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_DIGITS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1
    signs stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """Tokens, merges and special strings of a vocabulary file of this kind."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    if model["type"] != "BPE" or model["end_of_word_suffix"] != END or model["ignore_merges"]:
        raise ValueError("a byte-pair vocabulary with word ends is needed")
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    return {"tokens": list(model["vocab"]), "merges": merges, "special": [t["content"] for t in spec["added_tokens"]]}


class Tokens:
    """Byte-pair merging of words, and which neighbours stay apart.  A token is a number;
    ``inner`` and ``ending`` find it by its bytes inside and at the end of a word."""

    def __init__(self, spec: dict):
        alphabet = byte_alphabet()
        self.inner: dict[bytes, int] = {}
        self.ending: dict[bytes, int] = {}
        number = {}
        for i, token in enumerate(spec["tokens"]):
            ends = token.endswith(END) and token != END
            spelled = bytes(alphabet[c] for c in (token.removesuffix(END) if ends else token))
            (self.ending if ends else self.inner)[spelled] = number[token] = i
        self.rank = {(number[a], number[b]): (i, number[a + b]) for i, (a, b) in enumerate(spec["merges"])}
        self.begins = {b[:i] for b in (*self.inner, *self.ending) for i in range(1, len(b))}
        made: dict[int, int] = {}
        for (a, b), (i, whole) in self.rank.items():
            if max(made.get(a, -1), made.get(b, -1)) >= i:
                raise ValueError("a merge stands before one that makes its parts")
            made.setdefault(whole, i)
        self.bytes_of = {i: (b, ends) for ends, by in ((False, self.inner), (True, self.ending)) for b, i in by.items()}
        self.edges: dict[int, tuple[list, list] | None] = {}

    def split(self, word: bytes, ends: bool = True) -> list[tuple]:
        """The tokens of ``word`` as (number, rank of the merge, its two parts)."""
        parts = [((self.ending if ends and i == len(word) - 1 else self.inner)[word[i : i + 1]], -1, None, None) for i in range(len(word))]
        while len(parts) > 1:
            rank, i = min((self.rank.get((a[0], b[0]), (NEVER,))[0], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == NEVER:
                break
            a, b = parts[i : i + 2]
            parts[i : i + 2] = [(self.rank[a[0], b[0]][1], rank, a, b)]
        return parts

    def edges_of(self, token: int) -> tuple[list, list] | None:
        """(left, right): the parts of the token at its left and right edge, from a byte up
        to the token, each with the rank of the merge that takes it in.  None where the
        merges don't make the token of its own bytes."""
        if token not in self.edges:
            parts = self.split(*self.bytes_of[token])
            if len(parts) != 1 or parts[0][0] != token:
                self.edges[token] = None
            else:
                sides = []
                for part in (2, 3):
                    node, taken, edge = parts[0], NEVER, []
                    while node:
                        edge.append((node[0], taken))
                        taken, node = node[1], node[part]
                    sides.append(edge[::-1])
                self.edges[token] = sides[0], sides[1]
        return self.edges[token]

    def stays(self, before: int, token: int) -> bool:
        """Whether ``token`` stands by itself after the token ``before`` (-1: a word's
        start).  Merges happen by rank, the left one of equals first, so a merge across
        comes about if it ranks before the next merges on either side."""
        edge = self.edges_of(token)
        if edge is None or before < 0:
            return edge is not None
        right, left, i, j = self.edges_of(before)[1], edge[0], 0, 0
        while True:
            (a, to_a), (b, to_b) = right[i], left[j]
            across = self.rank.get((a, b))
            if across and across[0] < to_a and across[0] <= to_b:
                return False
            if to_a == to_b == NEVER:
                return True
            i, j = (i + 1, j) if to_a <= to_b else (i, j + 1)


#: A word so far: its live end, the places where a token may have begun (each: bytes back,
#: last token there, its count relative to the word's), and the count were it to end here.
FRESH = (b"", 0, -1, 0, 0)


class Machine:
    """The transducer, grown as texts need it.  ``step[state, column]`` holds the next
    state and the tokens emitted, as ``state * 256 + emitted + 128``; -1: not made yet."""

    def __init__(self, spec: dict, most: int = MOST_STATES):
        self.tokens, self.most = Tokens(spec), most
        self.special = re.compile("|".join(map(re.escape, sorted(spec["special"], key=len, reverse=True))) or r"(?!)")
        self.kinds: dict[str, int] = {}
        self.symbols: list[int] = []  # the symbol of each column, in order of first use
        self.column = np.full(SYMBOLS, -1, np.int64)
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.step = np.full((256, 64), -1, np.int32)
        self.texts = 0  # runs of texts so far
        self.seen, self.uses = np.zeros(256, np.int64), np.zeros(256, np.int64)
        self.use_symbols(np.array([0x20]))
        self.intern((HOLD, FRESH))
        self.intern((START, FRESH))

    def use_symbols(self, symbols: np.ndarray) -> None:
        for x in symbols[self.column[symbols] < 0].tolist():
            self.column[x] = len(self.symbols)
            self.symbols.append(x)
        while len(self.symbols) > self.step.shape[1]:
            self.step = np.concatenate([self.step, np.full((len(self.step), 64), -1, np.int32)], 1)

    def intern(self, state: tuple) -> int:
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
            if len(self.states) > len(self.step):
                self.step = np.concatenate([self.step, np.full_like(self.step, -1)])
                self.seen, self.uses = (np.concatenate([x, np.zeros_like(x)]) for x in (self.seen, self.uses))
        return self.number[state]

    def compact(self, held: list[np.ndarray]) -> list[np.ndarray]:
        """Keep the states in ``held`` and, up to half of the limit, those that most runs
        of texts have used; returns ``held`` renumbered."""
        n = len(self.states)
        stay = np.zeros(n, bool)
        stay[[HOLD, START]] = True
        for h in held:
            stay[h] = True
        often = np.argsort(-self.uses[:n], kind="stable")[: self.most // 2]
        stay[often[self.uses[often] > 1]] = True
        kept = np.flatnonzero(stay)
        new = np.full(n, -1, np.int64)
        new[kept] = np.arange(len(kept))
        step = self.step[kept].astype(np.int64)
        to = np.where(step < 0, -1, new[step >> 8])
        rows = max(256, 2 * len(kept))
        self.step = np.full((rows, step.shape[1]), -1, np.int32)
        self.step[: len(kept)] = np.where(to < 0, -1, to * 256 + (step & 255))
        self.seen, self.uses = (np.append(x[kept], np.zeros(rows - len(kept), np.int64)) for x in (self.seen, self.uses // 2))
        self.states = [self.states[i] for i in kept.tolist()]
        self.number = {state: i for i, state in enumerate(self.states)}
        return [new[h] for h in held]

    def grow(self, word: tuple, byte: int) -> tuple[tuple, int]:
        """The word with one more byte, and how its count changes."""
        text, tokens = word[0] + bytes([byte]), self.tokens
        now = last = final = None
        live = []
        for i in range(1, len(word) - 1, 3):
            back, before, count = word[i : i + 3]
            t = text[len(text) - back - 1 :]
            if now is None and (token := tokens.inner.get(t, -1)) >= 0 and tokens.stays(before, token):
                now, last = count + 1, token
            if final is None and (token := tokens.ending.get(t, -1)) >= 0 and tokens.stays(before, token):
                final = count + 1
            if t in tokens.begins:
                live.append((back + 1, before, count))
        flat = [x for back, before, count in live for x in (back, before, count - now)]
        end = text[len(text) - live[0][0] :] if live else b""
        return (end, *flat, 0, last, 0, final - now), final - word[-1]

    def transition(self, state: tuple, symbol: int) -> tuple[tuple, int]:
        kind, word = state
        if kind == HOLD:
            return ((START if symbol == 0x20 else HOLD), FRESH), 0
        if 128 <= symbol < 192:  # goes on with a character
            word, emitted = self.grow(word, symbol)
            return (kind, word), emitted
        byte, sort = (symbol, _ascii_class(symbol)) if symbol < 128 else (0xC0 + (symbol - 192) % 64, (symbol - 192) // 64)
        if sort == BLANK:
            return (START, FRESH), 0
        if kind == QUOTE and byte in SHORT:
            return (START, FRESH), self.count(bytes([0x27, byte])) - self.count(b"'")
        for start, then in LONG.values():
            if kind == start and byte == then:
                first = next(b for b, (k, _) in LONG.items() if k == kind)
                return (START, FRESH), self.count(bytes([0x27, first, byte])) - self.count(b"'") - self.count(bytes([first]))
        goes_on = sort == LETTER and kind in (LETTERS, QUOTE_R, QUOTE_V, QUOTE_L) or sort == OTHER and kind in (SIGNS, QUOTE)
        if goes_on:
            word, emitted = self.grow(word, byte)
            return (LETTERS if sort == LETTER else SIGNS, word), emitted
        word, emitted = self.grow(FRESH, byte)
        if sort == OTHER:
            return (QUOTE if byte == 0x27 else SIGNS, word), emitted
        if sort == DIGIT:
            return (NUMBER, word), emitted
        return (LONG[byte][0] if kind == QUOTE and byte in LONG else LETTERS, word), emitted

    def count(self, word: bytes) -> int:
        return len(self.tokens.split(word))

    def move(self, state: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and emitted tokens of all lanes."""
        first = state[self.seen[state] != self.texts]
        self.uses[first] += 1
        self.seen[first] = self.texts
        to = self.step[state, column]
        missing = np.flatnonzero(to < 0)
        if len(missing):
            for key in np.unique(state[missing].astype(np.int64) * SYMBOLS + column[missing]).tolist():
                at, c = divmod(key, SYMBOLS)
                after, emitted = self.transition(self.states[at], self.symbols[c])
                after = self.intern(after)
                self.step[at, c] = after * 256 + emitted + 128
            to = self.step[state, column]
        return to >> 8, (to & 255) - 128

    def run(self, symbols: np.ndarray) -> np.ndarray:
        """Tokens emitted at each byte of a run of texts."""
        self.texts += 1
        self.use_symbols(np.flatnonzero(np.bincount(symbols, minlength=SYMBOLS)))
        blank = self.column[0x20]
        n = -(-len(symbols) // CHUNK)
        padded = np.full(n * CHUNK, blank, np.int64)
        padded[: len(symbols)] = self.column[symbols]
        by_step = np.ascontiguousarray(padded.reshape(n, CHUNK).T)
        emitted = np.zeros((CHUNK, n), np.int8)
        leaves = np.full(n, HOLD, np.int64)  # the constant of each chunk's map; HOLD: open
        for i in range(CHUNK):
            if len(self.states) > self.most:
                (leaves,) = self.compact([leaves])
            leaves, emitted[i] = self.move(leaves, by_step[i])
        closed = (by_step == blank).any(0)
        until = np.where(closed, (by_step == blank).argmax(0), CHUNK)
        done = np.zeros(n, bool)  # chunks whose start state has been used
        while not done.all():
            # prefix scan: the state a chunk starts in is the last constant before it
            source = np.append(-1, np.maximum.accumulate(np.where(closed, np.arange(n), -1))[:-1])
            ready = np.flatnonzero(~done & (source == np.arange(n) - 1))
            state = np.where(source[ready] >= 0, leaves[source[ready]], START)
            lanes, at = ready, np.zeros(len(ready), np.int64)
            for i in range(CHUNK):
                going = until[lanes] > i
                if not going.all():
                    lanes, at, state = lanes[going], at[going], state[going]
                if not len(lanes):
                    break
                if len(self.states) > self.most:
                    leaves, state = self.compact([leaves, state])
                state, emitted[i, lanes] = self.move(state, by_step[i, lanes])
            leaves[lanes] = state  # chunks without a blank are constants from here on
            closed[ready] = done[ready] = True
        return emitted.T.reshape(-1)[: len(symbols)]

    def symbols_of(self, text: bytes) -> np.ndarray:
        """The symbol of each byte of normalised text."""
        data = np.frombuffer(text, np.uint8).astype(np.int64)
        wide = np.flatnonzero(data >= 0xC0)
        if len(wide):
            high = np.fromiter(map(self.kind, re.findall(r"[^\x00-\x7f]", text.decode())), np.int64, len(wide))
            data[wide] = 192 + 64 * high + (data[wide] - 0xC0)
        return data

    def kind(self, sign: str) -> int:
        if sign not in self.kinds:
            first, c = unicodedata.category(sign)[0], ord(sign)
            letter = first == "L" or any(lo <= c <= hi for lo, hi in NEW_LETTERS)
            digit = first == "N" or any(lo <= c <= hi for lo, hi in NEW_DIGITS)
            self.kinds[sign] = LETTER if letter else DIGIT if digit else OTHER
        return self.kinds[sign]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        extra = np.zeros(len(texts), np.int64)
        plain = []
        for i, text in enumerate(texts):
            if "<|" in text:
                text, extra[i] = self.special.subn(" ", text)
            plain.append(normalised(text).encode())
        symbols = self.symbols_of(b" ".join(plain) + b" ")
        stop = np.cumsum([len(p) + 1 for p in plain])
        total = np.append(0, np.cumsum(self.run(symbols), dtype=np.int64))
        return np.diff(total[np.append(0, stop)]) + extra


def _ascii_class(byte: int) -> int:
    c = chr(byte)
    return BLANK if c == " " else LETTER if c.isalpha() else DIGIT if c.isdigit() else OTHER


#: White space (the property White_Space).
_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Capital and small letters that are lower-cased otherwise here than by
#: Python (one form of sigma) or are newer than its tables.
_SMALL = {0x3A3: 0x3C3, 0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
_SMALL |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
_OWN_SMALL = re.compile("[" + "".join(map(chr, _SMALL)) + "]")


def normalised(text: str) -> str:
    """NFC, white space to blanks, lower case sign by sign."""
    if text.isascii():
        return _WHITE.sub(" ", text).lower()
    text = _WHITE.sub(" ", unicodedata.normalize("NFC", text))
    return _OWN_SMALL.sub(lambda m: chr(_SMALL[ord(m[0])]), text).lower()


def shared_machine(spec: dict, key: str) -> Machine:
    """The machine of this process; later tasks go on with its states."""
    store = sys.modules.setdefault("filingfold_machines", types.ModuleType("filingfold_machines")).__dict__
    if key not in store:
        store[key] = Machine(spec)
    return store[key]


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens): UTF-8 bytes and tokens of each text by the vocabulary
    file ``path``, which the driver reads (its size bounds what is sent to executors)."""
    spec = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared_machine(spec.value, path)
        for batch in batches:
            texts = batch["text"].fill_null("")
            _, offsets = text_buffers(texts)
            for lo, hi in runs(offsets):
                tokens = machine.counts(texts.slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo), pa.array(np.diff(offsets[lo : hi + 1])), pa.array(tokens)],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")


def op12_machine_counts(spark: SparkSession, sf_dir: str, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    counted = count_tokens(table(spark, sf_dir, "documents"), path)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
