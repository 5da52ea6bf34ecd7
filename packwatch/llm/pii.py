"""Personal data: anchors found by Aho-Corasick, expanded and validated by local parsers."""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from packwatch.llm.common import table

#: In the order in which spans are listed; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "account", "login")
BASE = KINDS[:4]

# The base patterns.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

IP_RUN = re.compile(r"[0-9.]*")
CARD_RUN = re.compile(r"[0-9\x20-]*")
#: What may stand behind a cue: a sign of assignment, then a value with a digit in it.
VALUE = re.compile(r"(?:[_-]?(?:key|number|no|id))?[\x20\"']{0,3}[:=#][\x20\"']{0,3}([A-Za-z0-9+/_.-]*[A-Za-z0-9+/=_-])", re.I)
ACCESS_KEY = re.compile(r"[A-Z0-9]{16}(?![A-Za-z0-9])")
IBAN = re.compile(r"([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
USERINFO = re.compile(r"://([^\s/?#@<>\"':]+:[^\s/?#@<>\"']+)@")
CUES = ("token", "password", "passwd", "secret", "api", "account", "acct", "iban", "passport", "ssn")
LEAST_VALUE = 6


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _iban(text: str) -> bool:
    plain = text.replace(" ", "")
    turned = plain[4:] + plain[:4]
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for sign in "0123456789":
        found.add_word(sign, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    found.add_word("AKIA", ("access", 4))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, ("cue", len(cue)))
    found.make_automaton()
    return found


def spans(text: str, anchors: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind in code points, end exclusive.

    Base kinds equal a leftmost, non-overlapping search with their patterns and the drop of
    matches that fail their check. A match lies in one run of the characters that its
    pattern can use and holds an anchor: the at-sign, the plus, or a digit. From each anchor
    that no earlier run of the kind has covered the run is read to its end and searched.
    """
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    email_end = ip_end = card_end = phone_end = account_end = 0
    for end, (kind, size) in anchors.iter(text):
        at = end - size + 1
        if kind == "digit":
            if at >= ip_end:
                ip_end = IP_RUN.match(text, at).end()
                for m in IP.finditer(text, at, ip_end):
                    if all(_byte(p) for p in m.group().split(".")):
                        out["ip"].append(m.span())
            if at >= card_end:
                card_end = CARD_RUN.match(text, at).end()
                for m in CARD.finditer(text, at, card_end):
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        out["card"].append(m.span())
            if at >= account_end and at >= 2 and text[at - 2 : at].isupper():
                m = IBAN.match(text, at - 2)
                if m and not text[at - 3 : at - 2].isalnum() and _iban(m[1]):
                    out["account"].append(m.span(1))
                    account_end = m.end(1)
        elif kind == "at":
            start = at
            while start > email_end and text[start - 1] in LOCAL:
                start -= 1
            m = DOMAIN.match(text, at) if start < at else None
            if m:
                out["email"].append((start, m.end()))
                email_end = m.end()
        elif kind == "plus":
            m = PHONE.match(text, at) if at >= phone_end else None
            if m:
                phone_end = m.end()
                if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    out["phone"].append(m.span())
        elif kind == "scheme":
            m = USERINFO.match(text, at)
            if m:
                out["login"].append(m.span(1))
        elif at >= account_end and not text[at - 1 : at].isalnum():
            m = ACCESS_KEY.match(text, end + 1) if kind == "access" else VALUE.match(text, end + 1)
            if kind == "access" and m:
                out["account"].append((at, m.end()))
                account_end = m.end()
            elif m and len(m[1]) >= LEAST_VALUE and any(c in "0123456789" for c in m[1]):
                out["account"].append(m.span(1))
                account_end = m.end(1)
    return out


def masked(text: str, found: dict[str, list[tuple[int, int]]]) -> str:
    """The text with its spans replaced by their kind; overlapping spans become one."""
    out, at = [], 0
    for start, end, kind in sorted((s, -e, k) for k in KINDS for s, e in found[k]):
        end = -end
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame, text_column: str = "text", mask: bool = False) -> DataFrame:
    """Rows (record, pii) for every row: record holds the input's columns, pii what was found.

    pii has a list of (kind, start, end) by kind and start, and the masked text if asked
    for. A null text has no spans and stays null; empty texts, repeated rows and an empty table need no
    care, as rows are worked on alone; texts are searched whole. Columns may have any name.
    """
    shape = "spans array<struct<kind: string, start: long, end: long>>, masked string"
    kinds = list(to_arrow_schema(T.StructType.fromDDL(shape)))

    def find(batches):
        anchors = automaton()
        for batch in batches:
            listed, clean = [], []
            for text in batch.column("text").to_pylist():
                found = spans(text or "", anchors)
                listed.append([{"kind": k, "start": s, "end": e} for k in KINDS for s, e in sorted(found[k])])
                clean.append(None if text is None or not mask else masked(text, found) if listed[-1] else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("record"), pa.array(listed, kinds[0].type), pa.array(clean, kinds[1].type)],
                ["record", "spans", "masked"],
            )

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("record"),
        F.col(f"`{text_column}`").alias("text"),
    )
    return rows.mapInArrow(find, f"record {rows.schema['record'].dataType.simpleString()}, {shape}")


def mask_documents(docs: DataFrame) -> DataFrame:
    """Documents with their personal data masked; same columns, n_chars counted anew."""
    found = personal_data(docs, mask=True)
    new = {"text": F.col("masked"), "n_chars": F.length("masked").cast("long")}
    return found.select(*[(new[c] if c in new else F.col(f"record.`{c}`")).alias(c) for c in docs.columns])


def listed(found: F.Column) -> F.Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def document_spans(spark, folder: str) -> DataFrame:
    """op9: counts, digest of the base spans and all spans of every whole document."""
    found = personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        F.col("record.doc_id").alias("doc_id"),
        *[count(k) for k in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
