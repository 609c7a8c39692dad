"""Token counts of a SentencePiece BPE vocabulary, by the whole-token shortcut.

``WholeTokens`` proves from the vocabulary alone, before any text is read, that

* no piece continues past a space mark, so merges never cross the start of a run of spaces and a text's
  count is the sum over pre-tokens (a run of spaces and what follows it up to the next space);
* characters that occur in no longer piece (a line feed, say) never merge, so a pre-token can be cut there;
* which vocabulary strings encode alone as exactly one token.

Pre-tokens that are such a string count 1 without being encoded. Only the rest is merged by the library,
and each distinct one once while it stays in a bounded cache.
"""

from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from matchloom.llm.common import id_text, kept, map_batches, slices

CACHE, LONGEST_CACHED, LIMIT = 300_000, 48, 4096
MARK = "▁"
_counters: dict[str, "WholeTokens"] = kept(__name__)


class WholeTokens:
    def __init__(self, path: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        sp, n = self.sp, self.sp.get_piece_size()
        plain = [p for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) for p in [sp.id_to_piece(i)]]
        if any(MARK in p.strip(MARK) or (p.endswith(MARK) and p.strip(MARK)) for p in plain):
            raise ValueError("a piece continues past a space mark; counts can't be summed over pre-tokens")
        if len(sp.encode("a  b ")) != len(sp.encode("a")) + len(sp.encode(" b")) + 1:
            raise ValueError("the vocabulary's normaliser alters spaces")
        self.lonely = "\n" if not any("\n" in p and len(p) > 1 for p in plain) else ""
        words = [p[1:] for p in plain if p.startswith(MARK) and len(p) > 1 and MARK not in p[1:]]
        self.whole = {w: 1 for w, ids in zip(words, sp.encode(words), strict=True) if len(ids) == 1}
        self.marked = dict(self.whole)  # after one space mark
        self.bare: dict[str, int] = {}  # after a line feed

    def _of(self, word: str) -> int:
        """Tokens of a space mark and ``word`` (not empty), which isn't in the cache."""
        if self.lonely and "\n" in word:
            first, *rest = word.split("\n")
            n = len(rest) + (self.marked.get(first) or self._of(first) if first else 1)
            for part in rest:
                if part:
                    if (k := self.bare.get(part)) is None:
                        k = len(self.sp.encode("\n" + part)) - 2
                        if len(part) <= LONGEST_CACHED:
                            if len(self.bare) >= CACHE:
                                self.bare.clear()
                            self.bare[part] = k
                    n += k
            return n
        n = len(self.sp.encode(word))
        if len(word) <= LONGEST_CACHED:
            if len(self.marked) >= CACHE:
                self.marked = dict(self.whole)
            self.marked[word] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")
        words, n = text.split(" "), 0
        if "" in words:
            pending, merged = 0, []
            for w in words:
                if w:
                    merged.append(" " * pending + w)
                    pending = 0
                else:
                    pending += 1
            words = merged
            if pending:  # spaces at the end
                n = 1 if pending == 1 else len(self.sp.encode(" " * (pending - 1)))
        get, of = self.marked.get, self._of
        counts = list(map(get, words))
        if None in counts:
            counts = [of(w) if k is None else k for w, k in zip(words, counts, strict=True)]
        return n + sum(counts)


def counter(path: str) -> WholeTokens:
    if path not in _counters:
        _counters[path] = WholeTokens(path)
    return _counters[path]


def token_counts(df: DataFrame, vocabulary: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of ``df``.

    ``vocabulary`` is the path of a SentencePiece BPE model on every executor. Null texts count as empty
    (0 tokens); control strings inside texts are ordinary text, as the library has it; ties and repeated
    rows are rows of their own; an empty table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for batch in batches:
            for ids, texts in slices(batch):
                n = [c.count(t.decode("utf-8", "replace")) if t else 0 for t in texts]
                sizes = pa.array([len(t) if t else 0 for t in texts], pa.int64())
                yield pa.record_batch([ids, sizes, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["id", "n_bytes", "n_tokens", "over_limit"])

    return map_batches(id_text(df, id_col, text_col), run, "id long, n_bytes long, n_tokens long, over_limit boolean")
