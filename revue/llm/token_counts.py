"""Token counts under a unigram model, with forward scores shared in a trie.

A pre-token is a run of characters other than space and tab to carriage return, after
the mark U+2581. Its tokens are the segmentation into pieces of the vocabulary with the highest sum of log
probabilities (of equal sums, the one with fewer tokens); a character that is no piece is spelt in byte
pieces. Only ordinary pieces are matched with text: ``<s>`` or ``<0x41>`` in a text is spelt like any other. Tokenizers are not trained: the log probabilities are Zipf's law over the piece numbers,
which a BPE vocabulary gives in the order of usefulness.

The forward score of a prefix (best sum up to its last character, and its tokens) depends on the
prefix alone. Distinct pre-tokens go into a trie, so it is computed once for each shared prefix
and kept at its node; the last node of a pre-token is its terminal, whose count is stored. Texts are handled in
blocks: only pre-tokens without a stored count touch the trie. The trie is ``DEPTH`` characters deep; the forward
scores of what follows in a longer pre-token go on from its node without being kept. Both tables are bounded and begin anew when
full, which costs time but changes no result. Documents are not shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revue.llm import textops as T

BLOCK, NODES_MOST, KNOWN_MOST, DEPTH = 4 << 20, 1_000_000, 2_000_000, 64
MARK = "▁"
ZIPF_SHIFT = 2.7
_INSIDE = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])


class Unigram:
    """Log probabilities of pieces, and of characters spelt in byte pieces.

    ``pieces`` by number: a string is matched with text, an integer is the piece of that byte, None is never used.
    """

    def __init__(self, pieces: list[str | int | None]):
        total = math.log(sum(1 / (k + ZIPF_SHIFT) for k in range(len(pieces))))
        score = {p: -math.log(k + ZIPF_SHIFT) - total for k, p in enumerate(pieces)}
        self.score = {p: s for p, s in score.items() if isinstance(p, str)}
        self.byte = {p: s for p, s in score.items() if isinstance(p, int)}
        self.longest = max((len(p) for p in self.score), default=1)
        self.floor = -math.log(len(pieces) + ZIPF_SHIFT) - total
        self.spelt: dict[str, tuple[float, int]] = {}
        lengths: dict[str, set[int]] = {}
        for piece in self.score:
            if len(piece) > 1:
                lengths.setdefault(piece[-2:], set()).add(len(piece))
        #: Lengths of the pieces that end in two given characters.
        self.lengths = {end: tuple(sorted(found)) for end, found in lengths.items()}

    def spell(self, char: str) -> tuple[float, int]:
        if char not in self.spelt:
            raw = char.encode()
            self.spelt[char] = sum(self.byte.get(b, self.floor) for b in raw), len(raw)
        return self.spelt[char]

    def forward(self, word: str, end: int, earlier: list[tuple[float, int]]) -> tuple[float, int]:
        """Best (score, -tokens) of ``word[:end]``; ``earlier`` holds those of the prefixes before, the last one last."""
        char = word[end - 1]
        score = self.score.get(char)
        before = earlier[-1]
        if score is None:
            score, tokens = self.spell(char)
            best = before[0] + score, before[1] - tokens
        else:
            best = before[0] + score, before[1] - 1
        for size in self.lengths.get(word[end - 2:end], ()) if end > 1 else ():
            if size > end:
                break
            score = self.score.get(word[end - size:end])
            if score is not None:
                before = earlier[-size]
                here = before[0] + score, before[1] - 1
                if here > best:
                    best = here
        return best

    def go_on(self, word: str, line: list[tuple[float, int]]) -> tuple[float, int]:
        """Best (score, tokens) of a word from the forward scores of its first characters; keeps the last ones only."""
        for end in range(len(line), len(word) + 1):
            line.append(self.forward(word, end, line))
            if len(line) > 4 * self.longest + 4 * DEPTH:
                del line[:-self.longest - 1]
        return line[-1][0], -line[-1][1]


class Trie:
    """Prefixes of pre-tokens with their forward scores."""

    def __init__(self, model: Unigram, most: int = NODES_MOST):
        self.model, self.most = model, most
        self._clear()

    def _clear(self) -> None:
        self.child: dict[int, int] = {}
        self.node: list[tuple[float, int]] = [(0.0, 0)]

    def insert(self, word: str) -> tuple[float, int]:
        """(score, tokens) of a word; only prefixes that no word before had are computed."""
        if len(self.node) + DEPTH > self.most:
            self._clear()
        at, line, node, child = 0, [self.node[0]], self.node, self.child
        for end, char in enumerate(word[:DEPTH], 1):
            key = (at << 21) | ord(char)
            to = child.get(key)
            if to is None:
                to = child[key] = len(node)
                node.append(self.model.forward(word, end, line))
            at = to
            line.append(node[at])
        return self.model.go_on(word, line)


class Counter:
    """Tokens of texts; remembers the terminal counts of at most ``most`` pre-tokens."""

    def __init__(self, pieces: list[str | int | None], nodes: int = NODES_MOST, most: int = KNOWN_MOST):
        self.trie, self.most = Trie(Unigram(pieces), nodes), most
        self._forget()

    def _forget(self) -> None:
        self.numbers = T.Numbers()
        self.tokens, self.score = np.zeros(1 << 12, np.int64), np.zeros(1 << 12)

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pre-tokens, tokens and log probability of each text of a block."""
        starts, ends, first = T.word_spans(data, offsets, _INSIDE)
        one, sample, which = np.unique(T.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if self.numbers.size + len(one) > self.most:
            self._forget()
        at = self.numbers.find(one)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            raw = data.tobytes()
            got = [self.trie.insert(MARK + raw[starts[s]:ends[s]].decode()) for s in sample[missing]]
            at[missing] = self.numbers.add(one[missing])
            while self.numbers.size > len(self.tokens):
                self.tokens = np.concatenate([self.tokens, np.zeros_like(self.tokens)])
                self.score = np.concatenate([self.score, np.zeros_like(self.score)])
            self.score[at[missing]] = [g[0] for g in got]
            self.tokens[at[missing]] = [g[1] for g in got]
        at = at[which]
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        tokens = np.bincount(text, self.tokens[at], len(offsets) - 1)
        score = np.bincount(text, self.score[at], len(offsets) - 1)
        return np.diff(first), tokens.astype(np.int64), score.astype(float)


def pieces_of(path: str) -> list[str | int | None]:
    """Pieces of a sentencepiece vocabulary file by number: text, the byte that one stands for, or None for markers."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def piece(k: int) -> str | int | None:
        if model.is_byte(k):
            return int(model.id_to_piece(k)[3:5], 16)
        return None if model.is_control(k) or model.is_unknown(k) or model.is_unused(k) else model.id_to_piece(k)
    return [piece(k) for k in range(model.get_piece_size())]


_COUNTERS: dict[str, Counter] = {}


def _count_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:  # a worker keeps it from task to task
            _COUNTERS[path] = Counter(pieces_of(path))
        for batch in batches:
            for row, end, data, offsets in T.blocks(batch.column(1), BLOCK):
                words, tokens, score = _COUNTERS[path].block(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(words.astype(np.int64)), pa.array(tokens),
                     pa.array(score)], ["id", "n_pretokens", "n_tokens", "log_prob"])
    return run


def token_counts(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return id, n_pretokens, n_tokens, log_prob: one row per input row.

    ``vocabulary`` is a sentencepiece file, found there on every host. Null counts as empty text: 0
    tokens, log probability 0. Null and repeated ids pass through; other columns are not read. Empty table: empty result.
    """
    kind = df.schema[id_col].dataType.simpleString()
    return (df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
            .mapInArrow(_count_batches(vocabulary), f"id {kind}, n_pretokens long, n_tokens long, log_prob double")
            .withColumnRenamed("id", id_col))
