"""Token-bounded chunks with overlap: code fences stay whole, text is packed by sentences."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Tokens of a chunk and of the overlap, and characters that the sentence splitter sees at a time.
MAX_TOKENS, OVERLAP, WINDOW = 3000, 200, 1_000_000
#: Texts that a worker holds as Python's own values at a time; a batch of Spark's has up to 10,000.
TEXTS = 100
FENCE = "```[\\s\\S]*?```"
_FENCE = re.compile(FENCE)
#: A sentence ends behind its marks, and the quotes and brackets that close it, where white space follows.
END = "[.!?…][.!?…\"'”’)\\]]*\\s+"
_END = re.compile(END)
_LONE = re.compile(r"(?<=\S) (?=\S)")


class Words:
    """A tokenizer whose tokens are words, each with the white space before it: for tests, and for counts that SQL can check."""

    _find = re.compile(r"\s*\S+|\s+\Z").findall

    def encode(self, text: str) -> list[str]:
        return [t for t in self._find(text) if t.strip()]

    def decode(self, tokens: list[str]) -> str:
        return "".join(tokens)

    #: As many tokens as a text can have, without counting them; a tokenizer may have none.
    most = staticmethod(len)


class RankFile:
    """Byte-level BPE by a rank file and the pattern that goes with it; special tokens' texts are ordinary text.

    spaces: under this pattern, a space between two characters that aren't white space can only begin a piece, so what follows from it on is encoded alike on its own."""

    def __init__(self, path: str, pattern: str, spaces: bool = False):
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self._encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._spaces = spaces

    def tail(self, text: str, n: int) -> list[int]:
        """The last n tokens, and where a piece may be cut off before them no more of the text is encoded."""
        at = len(text)
        while self._spaces and (at := at - 8 * n) > 0:
            if (cut := _LONE.search(text, at)) and len(found := self.encode(text[cut.start() :])) >= n:
                return found[-n:]
        return self.encode(text)[-n:]

    def encode(self, text: str) -> list[int]:
        return self._encoding.encode_ordinary(text)

    def decode(self, tokens: list[int]) -> str:
        return self._encoding.decode(tokens)

    def most(self, text: str) -> int:
        """No token is shorter than a byte."""
        return len(text) if text.isascii() else len(text.encode(errors="surrogatepass"))


class Named(RankFile):
    """A tokenizer that the library fetches by name, such as cl100k_base; needs a network or its cache."""

    def __init__(self, name: str = "cl100k_base"):
        import tiktoken

        self._encoding, self._spaces = tiktoken.get_encoding(name), False


@lru_cache(maxsize=4)
def _made(make: Callable, args: tuple):
    """One tokenizer per worker."""
    return make(*args)


def _tail(tokenizer, text: str, n: int) -> list:
    return tokenizer.tail(text, n) if hasattr(tokenizer, "tail") else tokenizer.encode(text)[-n:]


def segments(text: str) -> list[tuple[str, str]]:
    """('text' or 'code', part) in order; an unclosed fence is text, and empty gaps are left out."""
    out, at = [], 0
    for m in _FENCE.finditer(text):
        out += [("text", text[at : m.start()])] if at < m.start() else []
        out.append(("code", m.group()))
        at = m.end()
    return out + ([("text", text[at:])] if at < len(text) else [])


def sentences(text: str, window: int = WINDOW) -> Iterator[str]:
    """Stripped sentences. Long texts are seen in windows that end at their last space; one without progress is cut hard."""
    at = 0
    while at < len(text):
        end = min(at + window, len(text))
        if end < len(text) and (space := text.rfind(" ", at, end)) > at:
            end = space
        cuts = [at, *(m.end() for m in _END.finditer(text, at, end)), end]
        yield from (text[a:b].strip() for a, b in zip(cuts, cuts[1:]))
        at = end


def pack(text: str, tokenizer, max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP, split: Callable = sentences) -> list[tuple[str, int]]:
    """(chunk, tokens) of a text. A piece is added while the chunk's tokens stay within max_tokens, and always to an empty chunk, so an oversized
    sentence or fence is a chunk of its own. A chunk that ends before a sentence leaves its last `overlap` tokens to the next one; before a
    fence it leaves nothing. Tokens are the sum over pieces."""
    out: list[tuple[str, int]] = []
    held, n = "", 0
    for kind, part in segments(text):
        for piece in [part] if kind == "code" else split(part):
            size = len(tokenizer.encode(piece))
            if n + size > max_tokens and held:
                out.append((held.strip(), n))
                tail = _tail(tokenizer, held, overlap) if kind == "text" and overlap > 0 else []
                held = tokenizer.decode(tail) if tail else ""
                n = len(tokenizer.encode(held)) if held else 0
            held += ("\n" if kind == "code" else " ") + piece
            n += size
    return out + ([(held.strip(), n)] if held.strip() else [])


def pack_uncounted(text: str, tokenizer, max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP, split: Callable = sentences) -> list[str]:
    """The chunks of pack() alone. Pieces are counted when their tokens may not fit any more, so those of most texts, and the last ones of long texts, never are."""
    most = getattr(tokenizer, "most", None)
    if most is None:
        return [t for t, _ in pack(text, tokenizer, max_tokens, overlap, split)]
    out: list[str] = []
    held: list[str] = []
    n = bound = 0  # tokens of the counted pieces, and as many as the waiting ones can have
    waiting: list[str] = []
    for kind, part in segments(text):
        for piece in [part] if kind == "code" else split(part):
            size = most(piece)
            if n + bound + size > max_tokens:
                n += sum(len(tokenizer.encode(p)) for p in waiting)
                waiting, bound = [], 0
                if n + size > max_tokens:
                    size = len(tokenizer.encode(piece))
                    if n + size > max_tokens and held:
                        whole = "".join(held)
                        out.append(whole.strip())
                        tail = _tail(tokenizer, whole, overlap) if kind == "text" and overlap > 0 else []
                        held = [tokenizer.decode(tail)] if tail else []
                        n = len(tokenizer.encode(held[0])) if tail else 0
                    n += size
                    held.append(("\n" if kind == "code" else " ") + piece)
                    continue
            bound += size
            waiting.append(piece)
            held.append(("\n" if kind == "code" else " ") + piece)
    last = "".join(held).strip()
    return out + ([last] if last else [])


def chunks_of(text: Column, make: Callable, args: tuple = (), max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP, split: Callable = sentences) -> Column:
    """array<struct<text, token_count>> of each text; make(*args) builds the tokenizer once in each worker. split(text) gives the sentences of a text: a
    function of some module, so that a model it needs is loaded once in a worker. Null gives no chunk."""

    @F.pandas_udf("array<struct<text:string,token_count:int>>")
    def run(s: pd.Series) -> pd.Series:
        tokenizer = _made(make, args)
        return s.map(lambda t: [{"text": c, "token_count": n} for c, n in pack(t, tokenizer, max_tokens, overlap, split)] if t is not None else [])

    return run(text)


def chunk_documents(docs: DataFrame, make: Callable, args: tuple = (), max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP, text: str = "text", split: Callable = sentences, counted: bool = True) -> DataFrame:
    """A row per chunk: the documents' other columns, chunk_no from 1, text and, if counted, token_count. Each document is packed on its own; nothing is shuffled."""
    rest = docs.drop(text)
    schema = StructType([*rest.schema.fields, *StructType.fromDDL("chunk_no int, text string" + ", token_count int" * counted).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _made(make, args)
        return (c for b in batches for some in few(b) for c in _packed(some, tokenizer, max_tokens, overlap, split, schema.names, counted))

    return docs.select(*[F.col(f"`{c}`") for c in rest.columns], F.col(text)).mapInArrow(run, schema)


def few(batch):
    """A record batch, or an array, in parts of TEXTS rows, nothing copied: what a worker makes of texts is held for one part at a time, however many rows a batch has."""
    return (batch.slice(at, TEXTS) for at in range(0, len(batch), TEXTS))


def _packed(batch: pa.RecordBatch, tokenizer, max_tokens: int, overlap: int, split: Callable, names: list[str], counted: bool = True) -> Iterator[pa.RecordBatch]:
    *rest, texts = batch.columns
    packs = lambda t: pack(t, tokenizer, max_tokens, overlap, split) if counted else ((c,) for c in pack_uncounted(t, tokenizer, max_tokens, overlap, split))
    rows = [(i, n, *chunk) for i, t in enumerate(texts.to_pylist()) if t is not None for n, chunk in enumerate(packs(t), 1)]
    if rows:
        at, *made = zip(*rows)
        yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at, pa.int64())) for c in rest), *(pa.array(c, t) for c, t in zip(made, (pa.int32(), pa.string(), pa.int32())))], names=names)


def chunk_names(chunks: DataFrame, file_name: str = "file_name") -> DataFrame:
    """Names each chunk after its file: <stem>_chunk_<n>.txt."""
    return chunks.withColumn(file_name, F.concat(F.regexp_replace(file_name, r"\.[^.]*$", ""), F.lit("_chunk_"), F.col("chunk_no").cast("string"), F.lit(".txt")))


def new_chunks(chunks: DataFrame, existing: DataFrame) -> DataFrame:
    """Chunks that the existing table (unique_id, chunk_no) doesn't have."""
    return chunks.join(existing.select("unique_id", "chunk_no"), ["unique_id", "chunk_no"], "left_anti")


def token_count(text: Column, make: Callable, args: tuple = ()) -> Column:
    @F.arrow_udf("int")
    def run(s: pa.Array) -> pa.Array:
        tokenizer = _made(make, args)
        return pa.array([len(tokenizer.encode(t)) if t is not None else 0 for some in few(s) for t in some.to_pylist()], pa.int32())

    return run(text)


def segments_table(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, seg_no from 1, kind, text) of each document's segments, without Python: fences and the gaps between them, zipped."""
    fences = F.regexp_extract_all(F.col(text), F.lit(FENCE), 0)
    gaps = F.split(F.col(text), FENCE)
    both = F.flatten(F.transform(gaps, lambda g, i: F.filter(F.array(F.struct(F.lit("text").alias("kind"), g.alias("text")), F.struct(F.lit("code").alias("kind"), F.get(fences, i).alias("text"))), lambda x: x["text"].isNotNull() & (x["text"] != ""))))
    return docs.select(key, F.posexplode(both).alias("_i", "_s")).select(key, (F.col("_i") + 1).alias("seg_no"), F.col("_s.kind").alias("kind"), F.col("_s.text").alias("text"))
