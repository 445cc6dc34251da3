"""Token counts of a unigram tokenizer, without the tokens: count-only Viterbi.

An Aho-Corasick automaton over the UTF-8 bytes of the vocabulary enumerates, at
each position, the pieces that end there, longest first. Dynamic programming
carries only the best score and its piece count. Tie rules are the tokenizer's:
a later candidate must be strictly better, candidates come by ascending start
(the longest piece first), and a character that is no piece itself competes as
unknown, at the lowest score less 10, last; with byte fallback it counts a piece
for each of its bytes, else a run of unknown characters counts one.

The tokenizer splits a text before each run of word marks, and so does this:
equal words have equal counts. The words of a batch are counted once each, all
of a length class at the same time, as table look-ups over arrays of bounded
size; a very long word goes by itself, in lists as long as it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselorn.llm.common import batch
from tesselorn.llm.pieces import BYTE, MARK, NORMAL, USER_DEFINED, Model, parse, read_model, splits_at_spaces

UNKNOWN_LESS = 10.0
#: Cells of an array (words by bytes of the longest) that are counted at once.
AREA = 400_000
#: So few words of a part, or fewer, are counted one by one.
LONE = 4


class Automaton:
    """Aho-Corasick over bytes as arrays: a next state for each state and byte,
    and for each state the pieces that end in it, longest first."""

    def __init__(self, m: Model):
        scores = {p.encode(): s for p, s, t in zip(m.pieces, m.scores, m.types) if t in (NORMAL, USER_DEFINED)}
        own = [s for s, t in zip(m.scores, m.types) if t in (NORMAL, USER_DEFINED)]
        self.unknown = min(own, default=0.0) - UNKNOWN_LESS
        self.bytes = m.byte_fallback and sum(t == BYTE for t in m.types) == 256
        children: list[dict[int, int]] = [{}]
        ends: dict[int, tuple[int, float]] = {}
        for piece, score in scores.items():
            node = 0
            for b in piece:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                node = children[node][b]
            ends[node] = (len(piece), score)
        n = len(children)
        self.next = np.zeros((n, 256), np.int32)
        fail, found = np.zeros(n, np.int32), [()] * n
        level = [0]
        while level:
            below = []
            for node in level:
                if node:
                    self.next[node] = self.next[fail[node]]
                for b, child in children[node].items():
                    fail[child] = self.next[node][b] if node else 0
                    self.next[node][b] = child
                    below.append(child)
                own_end = (ends[node],) if node in ends else ()
                found[node] = own_end + (found[fail[node]] if node else ())
            level = below
        self.most = max(map(len, found))
        self.length = np.zeros((n, self.most), np.int32)
        self.score = np.zeros((n, self.most))
        self.kinds = np.array([len(f) for f in found], np.int32)
        for node, f in enumerate(found):
            for i, (size, score) in enumerate(f):
                self.length[node, i], self.score[node, i] = size, score

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Pieces of the best segmentation of each word."""
        sizes = np.array([len(w) for w in words], np.int64)
        out = np.zeros(len(words), np.int64)
        order = np.argsort(sizes, kind="stable")
        own, at = sizes[order], 0
        while at < len(order):
            # as many words as make an array of AREA at most; their greatest size is the last's
            end = at + int(np.searchsorted((own[at:] + 1) * np.arange(1, len(own) - at + 1), AREA, side="right"))
            if end - at <= LONE:
                end = at + 1
                out[order[at]] = self._one(words[order[at]])
            else:
                out[order[at:end]] = self._counts([words[i] for i in order[at:end]], own[at:end])
            at = end
        return out

    def _one(self, word: bytes) -> int:
        """The same for one word, without arrays."""
        best, count, lone = [0.0], [0], [False]
        state, since, n = 0, 0, len(word)
        ends: dict[int, list] = {}
        for j in range(1, n + 1):
            b = word[j - 1]
            state = int(self.next[state, b])
            if b & 0xC0 != 0x80:
                since = j - 1
            if state not in ends:
                ends[state] = list(zip(self.length[state, : self.kinds[state]].tolist(), self.score[state, : self.kinds[state]].tolist()))
            top, pieces, is_lone, single = -np.inf, 0, False, False
            if j == n or word[j] & 0xC0 != 0x80:
                for size, score in ends[state]:
                    single |= j - size == since
                    if best[j - size] + score > top:
                        top, pieces = best[j - size] + score, count[j - size] + 1
                if not single and best[since] + self.unknown > top:
                    top, is_lone = best[since] + self.unknown, True
                    pieces = count[since] + (j - since if self.bytes else 1 - lone[since])
            best.append(top)
            count.append(pieces)
            lone.append(is_lone)
        return count[n]

    def _counts(self, words: list[bytes], sizes: np.ndarray) -> np.ndarray:
        n, longest = len(words), int(sizes[-1])
        text = np.zeros((longest, n), np.uint8)
        flat = np.frombuffer(b"".join(words), np.uint8)
        column = np.repeat(np.arange(n), sizes)
        row = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        text[row, column] = flat
        best = np.full((longest + 1, n), -np.inf)
        count = np.zeros((longest + 1, n), np.int64)
        lone = np.zeros((longest + 1, n), bool)  # the best path's last piece is unknown
        best[0] = 0
        state, since = np.zeros(n, np.int32), np.zeros(n, np.int64)
        start_after = 0  # words are in order of size: those before it have ended
        for j in range(1, longest + 1):
            start_after = int(np.searchsorted(sizes, j, side="left"))
            at = np.arange(start_after, n)
            b = text[j - 1, at]
            state[at] = self.next[state[at], b]
            since[at] = np.where((b & 0xC0) == 0x80, since[at], j - 1)  # where this character starts
            own = state[at]
            score = np.full(len(at), -np.inf)
            pieces = np.zeros(len(at), np.int64)
            single = np.zeros(len(at), bool)
            for i in range(int(self.kinds[own].max(initial=0))):
                has = np.flatnonzero(self.kinds[own] > i)
                start = j - self.length[own[has], i]
                value = best[start, at[has]] + self.score[own[has], i]
                single[has] |= start == since[at[has]]
                better = value > score[has]
                score[has[better]] = value[better]
                pieces[has[better]] = count[start[better], at[has[better]]] + 1
            following = text[j, at] if j < longest else np.zeros(len(at), np.uint8)
            whole = (sizes[at] == j) | ((following & 0xC0) != 0x80)  # a character ends here
            need = np.flatnonzero(whole & ~single)
            start = since[at[need]]
            value = best[start, at[need]] + self.unknown
            better = value > score[need]
            if self.bytes:
                more = count[start, at[need]] + (j - start)
            else:
                more = count[start, at[need]] + ~lone[start, at[need]]
            score[need[better]] = value[better]
            pieces[need[better]] = more[better]
            lone[j, at[need[better]]] = True
            best[j, at] = np.where(whole, score, -np.inf)
            count[j, at] = pieces
        return count[sizes, np.arange(n)]


def segments(texts: pa.Array, m: Model) -> tuple[pa.Array, np.ndarray]:
    """The words that the tokenizer encodes apart, with their marks, of all
    texts; and how many each text has."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "").take(pa.array(np.arange(len(texts))))
    if m.charsmap:
        from tokenizers import normalizers

        mapped = normalizers.Precompiled(m.charsmap)
        texts = pa.array([mapped.normalize_str(t) for t in texts.to_pylist()], pa.large_string())
    if m.extra_spaces:
        texts = pc.replace_substring_regex(pc.utf8_trim(texts, " "), " +", " ")
    if m.dummy_prefix:
        texts = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
    texts = pc.replace_substring(texts, " ", MARK)
    if not splits_at_spaces(m):
        return texts, np.ones(len(texts), np.int64)
    # a break before each run of marks that follows something else; NUL marks the
    # breaks, so a text's own NULs become another single byte that is in no piece
    spare = [chr(i) for i in range(1, 128) if i != 32 and not any(chr(i) in p for p in m.pieces)]
    if not spare or any("\x00" in p for p in m.pieces):
        raise ValueError("this vocabulary has no byte to spare")
    texts = pc.replace_substring(texts, "\x00", spare[0])
    parts = pc.split_pattern(pc.replace_substring_regex(texts, f"([^{MARK}])({MARK})", "\\1\x00\\2"), "\x00")
    sizes = pc.list_value_length(parts).to_numpy()
    return parts.flatten(), sizes


def token_counts(docs: DataFrame, model: bytes | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) for each row: pieces of the whole text. Null and empty
    texts have none. Repeated rows give repeated rows; other columns are not
    looked at; an empty table gives an empty result. The model's pieces and
    scores are read as a unigram vocabulary."""
    data = model if model is not None else read_model()
    m = parse(data)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])

    def fold(batches):
        automaton = Automaton(m)
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                words, sizes = segments(part.column(1), m)
                coded = words.dictionary_encode()
                count = automaton.counts(coded.dictionary.cast(pa.large_binary()).to_pylist())[coded.indices.to_numpy()]
                upto = np.concatenate([[0], np.cumsum(count)])
                ends = np.cumsum(sizes)
                yield batch(schema, doc_id=part.column(0), n_tokens=upto[ends] - upto[ends - sizes])

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).mapInArrow(fold, "doc_id long, n_tokens long")
