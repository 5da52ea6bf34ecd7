"""BPE encoding and decoding with tree concatenation for long unsplit text.

Texts are cut at spaces and line ends, which the tokenizer drops and no token spans, so words
are encoded one by one and remembered. Where a file's rules are known, stretches of plain words are
lower-cased first, as fewer words differ then. What has no such place for a long stretch (a run of
letters, or a script without spaces) is normalised and split by the tokenizer's own rules, and
a piece that is still long is halved again and again. Halves are encoded in parallel and
joined bottom up.

Why a join is exact: byte-pair merging by rank, leftmost first, gives tokens t1..tn if and only
if merging each neighbouring pair alone gives that pair back, since the first merge to cross a
border would be the lowest there for the pair alone too. A join therefore encodes a window of
the last tokens of the left and the first of the right, and doubles it until the window begins
with the token that the left has there and ends with the one that the right has there: then
every neighbouring pair of the result lies in an encoding known to be right.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import sys
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from packwatch.llm.common import settle, table

#: A stretch without a cutting place of more characters than this goes through the tree.
LONG_PIECE = 4096
#: Words, and pieces of words, remembered per worker; the words before the last clearing are kept too.
REMEMBERED = 500_000
#: Longer words are not remembered.
LONGEST_WORD = 64

# Fixed values of the usual lower-casing byte-level files: the pattern that splits text, and
# what it comes to for words of printable ASCII and Latin-1 letters.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN_WORD = re.compile(r"[!-~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
#: What ends a stretch of plain words: any other character but a space or a line end.
NOT_PLAIN = r"[^!-~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF \n]"
WORD_END = re.compile("[ \n]|$")
PLAIN_SPLIT = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00DF-\u00F6\u00F8-\u00FF]+|[0-9]|[^\sa-z0-9\u00DF-\u00F6\u00F8-\u00FF]+"
)


def byte_symbols() -> dict[int, int]:
    """The letter that stands for each byte: itself if printable, else one above 255 in turn."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


def plain_rules(model: dict) -> bool:
    """Whether a file lower-cases, splits by SPLIT and works on bytes, and does nothing else."""
    normalizers = (model.get("normalizer") or {}).get("normalizers") or []
    parts = (model.get("pre_tokenizer") or {}).get("pretokenizers") or []
    return (
        [n["type"] for n in normalizers] == ["NFC", "Replace", "Lowercase"]
        and normalizers[1]["pattern"] == {"Regex": "\\s+"}
        and [p["type"] for p in parts] == ["Split", "ByteLevel"]
        and parts[0]["pattern"] == {"Regex": SPLIT}
        and (parts[0]["behavior"], parts[0]["invert"]) == ("Removed", True)
        and (parts[1]["add_prefix_space"], parts[1]["use_regex"]) == (False, False)
    )


class Remembered(dict):
    """Word to what is made of its ids; filled as words turn up, with one older generation."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, word: str):
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
        if len(word) <= LONGEST_WORD:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value


class Codec:
    """A tokenizer file with remembered words; one per worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            text = f.read()
        self.whole = Tokenizer.from_str(text)
        self.whole.no_truncation()
        self.whole.no_padding()
        model = json.loads(text)
        self.plain = plain_rules(model)
        self.suffix = model["model"].get("end_of_word_suffix") or ""
        model["model"]["end_of_word_suffix"] = None
        self.inner = Tokenizer.from_str(json.dumps(model)).model
        self.model = self.whole.model
        self.specials = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.odd = re.compile("|".join([*map(re.escape, self.specials), NOT_PLAIN]))
        self.not_plain = re.compile(NOT_PLAIN)
        self.token = [self.whole.id_to_token(i) or "" for i in range(self.whole.get_vocab_size())]
        self.symbols = byte_symbols()
        self.split = Remembered(self.piece_ids)
        self.kinds = {kind: Remembered(lambda w, make=make: make(self.ids(w))) for kind, make in
                      (("ids", tuple), ("bytes", self.as_bytes), ("text", self.as_text))}
        self.lowered = {
            "ids": Remembered(self.plain_ids),
            "bytes": Remembered(self.plain_bytes),
            "text": Remembered(lambda w: self.as_text(self.plain_ids(w))),
        }

    # words ------------------------------------------------------------------

    def as_bytes(self, ids) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def as_text(self, ids) -> tuple[str, str]:
        return " ".join(map(str, ids)), " ".join([self.token[i] for i in ids])

    def made(self, ids, kind: str):
        return {"ids": tuple, "bytes": self.as_bytes, "text": self.as_text}[kind](ids)

    def piece_ids(self, piece: str) -> bytes:
        """Ids of a piece, packed, as memory bounds how many pieces are remembered."""
        symbols = piece.encode("utf-8").decode("latin-1").translate(self.symbols)
        return self.as_bytes([t.id for t in self.model.tokenize(symbols)])

    def plain_bytes(self, word: str) -> bytes:
        """Packed ids of a plain word in lower case, piece by piece."""
        return b"".join(map(self.split.__getitem__, PLAIN_SPLIT.findall(word)))

    def plain_ids(self, word: str) -> tuple[int, ...]:
        packed = self.plain_bytes(word)
        return struct.unpack(f"<{len(packed) // 4}I", packed)

    def ids(self, word: str) -> Sequence[int]:
        """Ids of a word: piece by piece where the rules are known, else by the library."""
        if not word:
            return []
        if self.plain and PLAIN_WORD.fullmatch(word) and not (self.special and self.special.search(word)):
            return self.plain_ids(word.lower())
        return self.whole.encode(word, add_special_tokens=False).ids

    def words(self, text: str, kind: str) -> list:
        """What is made of each word of a text; spaces and line ends have none."""
        word, lowered, out, at = self.kinds[kind], self.lowered[kind], [], 0
        if not self.plain:
            return list(map(word.__getitem__, text.replace("\n", " ").split(" ")))
        if self.not_plain.search(text) or any(s in text for s in self.specials):
            for m in self.odd.finditer(text):
                if m.start() < at:
                    continue
                begin = max(text.rfind(" ", at, m.start()), text.rfind("\n", at, m.start()), at - 1) + 1
                out += map(lowered.__getitem__, text[at:begin].lower().replace("\n", " ").split(" "))
                at = WORD_END.search(text, m.end()).start()
                out.append(word[text[begin:at]])
        out += map(lowered.__getitem__, text[at:].lower().replace("\n", " ").split(" "))
        return out

    # long stretches -----------------------------------------------------------

    def pieces(self, stretch: str) -> list[tuple[int | None, str]]:
        """Special ids, and pieces in byte symbols that merges never leave."""
        out: list = []
        for part in self.special.split(stretch) if self.special else [stretch]:
            if part in self.specials:
                out.append((self.specials[part], ""))
            elif part:
                normal = self.whole.normalizer.normalize_str(part) if self.whole.normalizer else part
                out += [(None, p) for p, _ in self.whole.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def run(self, symbols: str, last: bool) -> list[tuple[int, int]]:
        """(id, symbols) of a piece, or of a part of one that does not end it."""
        if not symbols:
            return []
        found = [(t.id, len(t.value)) for t in (self.model if last else self.inner).tokenize(symbols)]
        if last:
            found[-1] = (found[-1][0], found[-1][1] - len(self.suffix))
        return found

    def join(self, left: list, right: list, symbols: str, last: bool) -> list:
        """Exact encoding of two neighbouring parts; ``symbols`` are those of both."""
        if not left or not right:
            return self.run(symbols, last)
        k = 4
        while True:
            a, b = left[-k:], right[:k]
            begin = sum(n for _, n in left[: len(left) - len(a)])
            end = len(symbols) - sum(n for _, n in right[len(b) :])
            at_end = len(b) == len(right)
            window = self.run(symbols[begin:end], last and at_end)
            if (len(a) == len(left) or window[0] == a[0]) and (at_end or window[-1] == b[-1]):
                return left[: len(left) - len(a)] + window + right[len(b) :]
            k *= 2

    def tree(self, leaves: list[tuple[str, list]], last: bool = True) -> list:
        """Join the encoded leaves of one piece, halves first."""
        if len(leaves) == 1:
            return leaves[0][1]
        half = len(leaves) // 2
        left = self.tree(leaves[:half], False)
        right = self.tree(leaves[half:], last)
        return self.join(left, right, "".join(s for s, _ in leaves), last)


def codec(path: str) -> Codec:
    """The worker's codec of a file; kept in the process, as tasks bring their own globals."""
    kept = sys.__dict__.setdefault("_llm_codecs", {})
    if path not in kept:
        kept[path] = Codec(path)
    return kept[path]


_STRETCH = "[^ \n]{%d,}"


def has_long_stretch(text) -> F.Column:
    """Whether a text has a stretch without space or line end that the tree is for."""
    return (F.length(text) > LONG_PIECE) & text.rlike("(?:^|[ \n])" + _STRETCH % (LONG_PIECE + 1))


def cut(text: str, c: Codec) -> list[tuple[int, int, str]]:
    """Parts of a text in order: (kind, last, content).

    Kind 0 is ordinary text, kind 1 a special id in digits, kind 2 a leaf in byte symbols; last
    marks the leaf that ends its piece.
    """
    out, at = [], 0
    for m in re.finditer(_STRETCH % (LONG_PIECE + 1), text):
        if m.start() > at:
            out.append((0, 1, text[at : m.start()]))
        for special, symbols in c.pieces(m.group()):
            if special is not None:
                out.append((1, 1, str(special)))
                continue
            starts = range(0, len(symbols), LONG_PIECE)
            out += [(2, int(s + LONG_PIECE >= len(symbols)), symbols[s : s + LONG_PIECE]) for s in starts]
        at = m.end()
    if at < len(text):
        out.append((0, 1, text[at:]))
    return out


def leaf_ids(kind: int, last: int, content: str, c: Codec) -> list[tuple[int, int]]:
    if kind == 0:
        return [(i, 0) for ids in c.words(content, "ids") for i in ids]
    if kind == 1:
        return [(int(content), 0)]
    return c.run(content, bool(last))


def joined(parts: list[tuple[int, int, str, list[int], list[int]]], c: Codec) -> list[int]:
    """All ids of a text from its encoded parts in order."""
    ids, leaves = [], []
    for kind, last, content, tokens, widths in parts:
        if kind != 2:
            ids += tokens
            continue
        leaves.append((content, list(zip(tokens, widths, strict=True))))
        if last:
            ids += [i for i, _ in c.tree(leaves)]
            leaves = []
    return ids


def map_text(docs: DataFrame, vocabulary: str, kind: str, finish, schema: str) -> DataFrame:
    """Encode the texts of (row, text) and map each to columns.

    ``kind`` is what is made of a word's ids (ids, bytes or text), ``finish(list of those)`` gives the
    values of the columns that ``schema`` names. ``row`` is a struct that comes back unchanged. A null text is
    empty. Long stretches go leaf by leaf over all tasks and are joined by tree per text.
    """
    spark = docs.sparkSession
    texts = docs.select("row", F.coalesce("text", F.lit("")).alias("text"))
    plain = texts.where(~has_long_stretch(F.col("text")))
    fields = list(to_arrow_schema(T.StructType.fromDDL(schema)))
    names, kinds = [f.name for f in fields], [f.type for f in fields]

    def direct(batches):
        c = codec(vocabulary)
        for batch in batches:
            values = [finish(c.words(t, kind)) for t in batch.column("text").to_pylist()]
            columns = [pa.array([v[i] for v in values], kinds[i]) for i in range(len(kinds))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], ["row", *names])

    row_type = texts.schema["row"].dataType.simpleString()
    full = f"row {row_type}, {schema}"
    short = plain.mapInArrow(direct, full)

    def leaves(batches):
        c = codec(vocabulary)
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                parts = cut(text, c)
                for at in range(0, len(parts), 256):
                    some = parts[at : at + 256]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "row": pa.array([row] * len(some), batch.schema.field("row").type),
                            "part": list(range(at, at + len(some))),
                            "kind": pa.array([p[0] for p in some], pa.int32()),
                            "last": pa.array([p[1] for p in some], pa.int32()),
                            "content": [p[2] for p in some],
                        }
                    )

    columns = f"row {row_type}, part long, kind int, last int, content string"

    def encoded(batches):
        c = codec(vocabulary)
        for batch in batches:
            kind, last, content = (batch.column(n).to_pylist() for n in ("kind", "last", "content"))
            got = [leaf_ids(*x, c) for x in zip(kind, last, content, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([[i for i, _ in g] for g in got], pa.list_(pa.int32())),
                    pa.array([[n for _, n in g] for g in got], pa.list_(pa.int32())),
                ],
                [*batch.schema.names, "ids", "widths"],
            )

    def together(group: pa.Table) -> pa.Table:
        c = codec(vocabulary)
        group = group.sort_by("part")
        parts = list(zip(*(group[n].to_pylist() for n in ("kind", "last", "content", "ids", "widths")), strict=True))
        values = finish([c.made(joined(parts, c), kind)])
        made = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
        return pa.table([group["row"].slice(0, 1), *made], ["row", *names])

    # The leaves are stored: a lost task encodes its own again, and the number of a text is
    # fixed, also where whole rows repeat.
    parts = texts.where(has_long_stretch(F.col("text"))).mapInArrow(leaves, columns)
    tree = settle(parts.withColumn("copy", F.monotonically_increasing_id() - F.col("part")), "bpe-leaves")
    tree = tree.repartition("copy", "part").mapInArrow(encoded, f"{columns}, copy long, ids array<int>, widths array<int>")
    long = tree.groupBy("copy").applyInArrow(together, full)
    return short.unionByName(long)


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """op4 for (doc_id, text): token count, digest of the ids and of the decoded text.

    A null or empty text has no tokens; its digests are those of the empty string. The file
    needs no decoder of its own: tokens are joined by a space, as the library does.
    """

    def finish(words):
        ids = " ".join([w[0] for w in words if w[0]])
        text = " ".join([w[1] for w in words if w[0]])
        return (
            ids.count(" ") + 1 if ids else 0,
            hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        )

    rows = docs.select(F.struct("doc_id").alias("row"), "text")
    out = map_text(rows, vocabulary, "text", finish, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def encoded_documents(spark, folder: str) -> DataFrame:
    """op4: every whole document, encoded and decoded."""
    import public_tokenizers

    return round_trip(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
