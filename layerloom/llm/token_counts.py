"""Word-piece lengths of texts by a linear longest-match automaton.

The automaton is a trie of the vocabulary's bytes. Each node has a failure link,
to the node reached once the longest pieces before it are popped, and the number
of pieces popped on the way; following a word's bytes once and adding up those
numbers gives the length of its greedy longest-match split without building it.

Words are runs between Unicode white space. As in byte-level vocabularies, a
word's first piece carries the space before it; other pieces have none. A word
with a byte that no piece covers is one unknown token. Empty and NULL texts have
no words and no tokens. Rows stand alone: keys may be NULL or repeated, and no
shuffle is needed.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Words remembered per task, and the longest that is; both bound memory only.
MEMO_WORDS = 400_000
MEMO_LENGTH = 64


def read_vocabulary(path: str) -> list[bytes]:
    """The pieces of a file with one base-64 piece and its rank per line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class Automaton:
    """``edges`` maps node * 256 + byte to a node; ``fail`` is -1 where no split can go on."""

    def __init__(self, pieces: Iterable[bytes]):
        edges: dict[int, int] = {}
        parent, byte, final = [-1], [0], [False]
        for piece in pieces:
            node = 0
            for b in piece:
                node_key = node << 8 | b
                node = edges.get(node_key, -1)
                if node < 0:
                    node = edges[node_key] = len(parent)
                    parent.append(node_key >> 8)
                    byte.append(b)
                    final.append(False)
            final[node] = node > 0
        depth = [0] * len(parent)
        for node in range(1, len(parent)):
            depth[node] = depth[parent[node]] + 1
        fail, popped = [-1] * len(parent), [0] * len(parent)
        for node in sorted(range(1, len(parent)), key=depth.__getitem__):
            if final[node]:
                fail[node], popped[node] = 0, 1
                continue
            at, count = fail[parent[node]], popped[parent[node]]
            while at >= 0 and (at << 8 | byte[node]) not in edges:
                count += popped[at]
                at = fail[at]
            if at >= 0:
                fail[node], popped[node] = edges[at << 8 | byte[node]], count
        self.edges, self.fail, self.popped = edges, fail, popped

    def length(self, word: bytes) -> int:
        """Pieces in the greedy longest-match split of ``word``; 1 if it has none."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node, count = 0, 0
        for b in word:
            step = edges.get(node << 8 | b)
            while step is None:
                if fail[node] < 0:
                    return 1
                count += popped[node]
                node = fail[node]
                step = edges.get(node << 8 | b)
            node = step
        while node:
            if fail[node] < 0:
                return 1
            count += popped[node]
            node = fail[node]
        return count


class _Lengths(dict):
    """Lengths of words met so far in a task; misses run the automaton."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.length(b" " + word.encode())
        if len(word) <= MEMO_LENGTH:
            self[word] = n
        return n


def token_counts(
    docs: DataFrame, *, vocabulary: str = DEFAULT_VOCABULARY, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``n_words`` and ``n_tokens`` of every row.

    The vocabulary is read on the driver; its automaton (a few MB, fixed by the
    file) is broadcast.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(read_vocabulary(vocabulary)))

    def count(batches):
        lengths = _Lengths(shared.value)
        of = lengths.__getitem__
        for batch in batches:
            words, tokens = [], []
            for t in batch.column("text"):
                split = t.as_py().split() if t.is_valid else []
                words.append(len(split))
                tokens.append(sum(map(of, split)))
                if len(lengths) > MEMO_WORDS:
                    lengths.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                names=["key", "n_words", "n_tokens"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(count, f"key {kind}, n_words bigint, n_tokens bigint")
