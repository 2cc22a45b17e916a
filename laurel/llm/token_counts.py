"""Token counts with a whole-token shortcut (operator 13).

Before any text is read, every vocabulary string that ends a word is put through the
tokenizer's own merges.  Those that come out as one token are proven: a word of the text
that equals one counts as one token, without merging.  Only the other words are merged, each
distinct one about once a worker.
"""

import functools

import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from laurel.llm.packing import PLAIN, WORD, Recent, byte_letters

LIMIT = 2048
WORD_END = "</w>"


def proven_words(path: str) -> frozenset[str]:
    """Vocabulary strings that, as a word of a text, are encoded as that one token.

    Only strings that are one word of printable Latin-1 are looked at, as other words go
    through the whole tokenizer anyway.  There are at
    most as many as the vocabulary has entries.
    """
    tokenizer = Tokenizer.from_file(path)
    to_byte = {letter: b for b, letter in byte_letters().items()}
    proven = set()
    for spelt in tokenizer.get_vocab(with_added_tokens=False):
        word = spelt.removesuffix(WORD_END)
        if word == spelt or not word or not set(word) <= to_byte.keys():
            continue
        tokens = tokenizer.model.tokenize(word)
        try:
            text = bytes(to_byte[c] for c in word).decode()
        except UnicodeDecodeError:
            continue
        if len(tokens) == 1 and tokens[0].value == spelt and PLAIN.fullmatch(text) and WORD.findall(text) == [text]:
            proven.add(text)
    return frozenset(proven)


class TokenCounter:
    """Numbers of tokens: proven words count one, the rest is merged and remembered.

    Printable Latin-1 is split into words here.  Other texts are cut at blanks, where no
    token passes, and the stretches that aren't plain, or may hold a special string, go
    through the whole tokenizer.
    """

    def __init__(self, path: str, proven: frozenset[str], limit=200_000):
        self.whole = Tokenizer.from_file(path)
        self.proven = proven
        self.letters = byte_letters()
        self.merged = Recent(self._merge, limit)
        self.stretches = Recent(self._stretch, 20_000)

    def _merge(self, word):
        spelt = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return len(self.whole.model.tokenize(spelt))

    def _stretch(self, part):
        return len(self.whole.encode(part, add_special_tokens=False).ids)

    def _plain(self, text):
        words = WORD.findall(text.lower())
        rest = [w for w in words if w not in self.proven]
        return len(words) - len(rest) + sum(map(self.merged.__getitem__, rest))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if "<|" not in text and PLAIN.fullmatch(text):
            return self._plain(text)
        plain, total = [], 0
        for part in text.replace("\n", " ").split(" "):
            if "<|" not in part and PLAIN.fullmatch(part):
                plain.append(part)
            elif len(part) > 1_000:  # too long to remember
                total += self._stretch(part)
            else:
                total += self.stretches[part]
        return total + self._plain(" ".join(plain))


@functools.lru_cache(1)
def _counter(path, proven) -> TokenCounter:
    """One for each worker, kept from task to task."""
    return TokenCounter(path, proven)


def count_tokens(docs: DataFrame, limit=LIMIT, tokenizer=None) -> DataFrame:
    """Rows ``doc_id, n_bytes, n_tokens, over_limit``, one for each document.

    The number is the one the tokenizer library gives for the whole text without begin, end or
    padding; special strings inside a text are special tokens, as is its default.  A null or
    empty text has none.  Repeated rows and null ids each give a row; other columns play no part.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    # at most one string a vocabulary entry
    sent = docs.sparkSession.sparkContext.broadcast(proven_words(path))

    def run(batches):
        count = _counter(path, sent.value).count
        for batch in batches:
            texts = batch.column("text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            tokens = pa.array([count(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, tokens], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
