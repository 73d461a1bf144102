"""Personal data by anchor expansion.

One Aho-Corasick automaton finds anchors (at-signs, schemes, digits, plus signs, identifier cues) in the whole text. A
parser of its own for each kind expands an anchor to its boundaries and validates it. The base kinds give the same spans
as a leftmost non-overlapping search with the patterns in BASE; the others come on top and never replace a base span.

Defined results: a null or empty text has no spans; a text of any length is read whole; repeated rows give repeated
results; extra columns pass through `find_spans`, and columns named `spans` or `redacted` of the input are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

# Kinds in their order; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "ssn", "passport", "user id", "userid", "customer id")

DIGITS = frozenset("0123456789")
ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | DIGITS
LOCAL = ALNUM | frozenset("._%+-")
DOMAIN = ALNUM | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
IDENTIFIER = ALNUM | frozenset("-")
URL_END = frozenset(" \t\n\v\f\r<>\"'`{}|\\^")

SPAN = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _run(text: str, at: int, allowed: frozenset) -> int:
    """End of the run of allowed characters that begins at `at`."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def emails(text: str, ats: list[int]) -> list[tuple[int, int]]:
    out, free = [], 0
    for at in ats:
        if at < free:
            continue
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        end = _run(text, at + 1, DOMAIN)
        if start == at or end == at + 1:
            continue
        labels = 0
        while end < len(text) and text[end] == "." and (more := _run(text, end + 1, DOMAIN)) > end + 1:
            end, labels = more, labels + 1
        if labels:
            out.append((start, end))
            free = end
    return out


def digit_runs(digits: list[int]) -> list[tuple[int, int]]:
    runs: list[tuple[int, int]] = []
    for at in digits:
        if runs and runs[-1][1] == at:
            runs[-1] = (runs[-1][0], at + 1)
        else:
            runs.append((at, at + 1))
    return runs


def addresses(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Four digit runs joined by single dots; a match whose parts exceed 255 uses its text up all the same."""
    out, i = [], 0
    while i + 3 < len(runs):
        part = runs[i : i + 4]
        if all(b[0] == a[1] + 1 and text[a[1]] == "." for a, b in zip(part, part[1:])):
            if all(len(x := text[a:b].lstrip("0")) < 4 and int(x or 0) <= 255 for a, b in part):
                out.append((part[0][0], part[3][1]))
            i += 4
        else:
            i += 1
    return out


def luhn(digits: str) -> bool:
    odd = sum(int(c) for c in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def cards(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out, i = [], 0
    while i < len(runs):
        j, count = i, runs[i][1] - runs[i][0]
        while j + 1 < len(runs) and runs[j + 1][0] == runs[j][1] + 1 and text[runs[j][1]] in " -":
            j += 1
            count += runs[j][1] - runs[j][0]
        if 12 <= count <= 19:
            start, end = runs[i][0], runs[j][1]
            if luhn("".join(c for c in text[start:end] if c in DIGITS)):
                out.append((start, end))
        i = j + 1
    return out


def phones(text: str, pluses: list[int]) -> list[tuple[int, int]]:
    out = []
    for at in pluses:
        if at + 1 >= len(text) or text[at + 1] not in DIGITS:
            continue
        end = _run(text, at + 2, PHONE)
        while end > at + 2 and text[end - 1] not in DIGITS:
            end -= 1
        if end >= at + 4 and 9 <= sum(c in DIGITS for c in text[at:end]) <= 15:
            out.append((at, end))
    return out


def urls(text: str, schemes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A scheme and all that may stand in an address, without the punctuation that closes a sentence."""
    out, free = [], 0
    for start, host in schemes:
        if start < free:
            continue
        end = host
        while end < len(text) and text[end] not in URL_END:
            end += 1
        while end > host and text[end - 1] in ".,;:!?)]":
            end -= 1
        if end > host and text[host] in ALNUM:
            out.append((start, end))
            free = end
    return out


def accounts(text: str, cues: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The identifier behind a cue: a word of letters, digits and hyphens with at least five digits."""
    out, free = [], 0
    for start, end in cues:
        if start and text[start - 1] in ALNUM:
            continue
        at = end
        while at < len(text) and at < end + 4 and text[at] in " :#=.\t":
            at += 1
        stop = _run(text, at, IDENTIFIER)
        while stop > at and text[stop - 1] == "-":
            stop -= 1
        if at > end and at >= free and sum(c in DIGITS for c in text[at:stop]) >= 5:
            out.append((at, stop))
            free = stop
    return out


def automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for c in "@+" + "".join(sorted(DIGITS)):
        made.add_word(c, ("digit" if c in DIGITS else c, 1))
    for word in SCHEMES:
        made.add_word(word, ("scheme", len(word)))
    for word in CUES:
        for form in {word, word.upper(), word.capitalize()}:
            made.add_word(form, ("cue", len(form)))
    made.make_automaton()
    return made


def spans_of(text: str | None, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind in the order of KINDS; offsets are code points, the end is exclusive."""
    if not text:
        return []
    found: dict[str, list] = {"@": [], "+": [], "digit": [], "scheme": [], "cue": []}
    for last, (kind, n) in anchors.iter(text):
        found[kind].append((last + 1 - n, last + 1) if kind in ("scheme", "cue") else last)
    if not any(found.values()):
        return []
    runs = digit_runs(found["digit"])
    by_kind = {
        "email": emails(text, found["@"]), "ip": addresses(text, runs), "card": cards(text, runs),
        "phone": phones(text, found["+"]), "url": urls(text, found["scheme"]), "account": accounts(text, found["cue"])}
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(((k, a, b) for k, both in by_kind.items() for a, b in both), key=lambda s: (s[1], order[s[0]]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each group of overlapping spans replaced by the kind of its first one, as in [EMAIL]."""
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds `spans` (kind, start, end) and `redacted` to any table with a text column."""
    kept = [c for c in docs.columns if c not in ("spans", "redacted")]
    fields = [docs.schema[c] for c in kept]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # texts of 256 rows at a time as Python strings
                part = batch.slice(at, 256)
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                spans = [spans_of(t, anchors) for t in texts]
                rows = [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(rows, kind),
                     pa.array([redact(t, s) for t, s in zip(texts, spans)], pa.string())],
                    [*part.schema.names, "spans", "redacted"])

    schema = T.StructType([*fields, T.StructField("spans", SPAN), T.StructField("redacted", T.StringType())])
    return docs.select(*kept).mapInArrow(find, schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the result of find_spans: one row for each of its rows."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    of_kind = lambda k: F.filter("spans", lambda s: s["kind"] == k)
    return found.select(
        "doc_id", *[F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"))
