"""Personal data in whole texts: patterns propose, checksums confirm, nearby words adjust the score (operator 10)."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import freed, pieces

KINDS = ("email", "ip", "card", "phone", "iban", "secret")

#: The patterns of the base kinds, written so that a search takes time in proportion to the text. An email is
#: sought from its @, an address from where a run of digits begins; a match elsewhere in such a run would not be leftmost.
LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Proposals of the method beyond these: secrets that a name or a known beginning gives away, account numbers, and phone
#: numbers without a country code.
SECRET = re.compile(r"""(?i:(?<![A-Za-z])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)["']?[\x20]{0,3}[:=][\x20]{0,3}["']?)([A-Za-z0-9_/+=.-]{12,200})|(?<![A-Za-z0-9])(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36})(?![A-Za-z0-9])""")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
#: Characters of an account number by country.
IBAN_LENGTHS = {
    code: n
    for n, codes in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
    }.items()
    for code in codes.split()
}
LOCAL_PHONE = re.compile(r"(?<![0-9+.\-])\(?[0-9]{2,5}\)?(?:[\x20.\-][0-9]{2,5}){1,4}(?![0-9.\-])")

#: Words near a span that raise its score, and words before it that lower it.
CONTEXT = {
    "email": ({"mail", "email", "e-mail", "contact", "correo"}, {"example"}),
    "ip": ({"ip", "address", "host", "server", "login"}, {"version", "release", "section"}),
    "card": ({"card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta"}, {"order", "isbn", "serial", "id"}),
    "phone": ({"phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"}, {"isbn", "order", "version"}),
    "iban": ({"iban", "account", "bank", "konto", "compte", "cuenta"}, set()),
    "secret": ({"token", "secret", "password", "key", "credentials"}, {"example", "placeholder"}),
}
#: Scores by kind before the context is seen; a hit of the context adds or takes 0.3. Proposals beyond the base need 0.5.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "secret": 0.7, "local": 0.3}
NEAR = 48
DIGIT = re.compile("[0-9]")
WORD = re.compile(r"[^\W\d_][\w-]*")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _ibans(text: str) -> list[tuple[int, int]]:
    """Account numbers that mod 97 confirms. A proposal may have taken in words or numbers that follow it, so its shorter ends
    between groups are tried too: the length of its country first, then the longest. What none confirms hides no later start."""
    out: list[tuple[int, int]] = []
    for start in IBAN_START.finditer(text):
        if out and start.start() < out[-1][1] or not (m := IBAN.match(text, start.start())):
            continue
        s = m.group()
        ends = [(len(c), e) for e in [len(s), *(i for i in range(len(s) - 1, 0, -1) if s[i] == " ")] if len(c := s[:e].replace(" ", "")) >= 15]
        ends.sort(key=lambda x: x[0] != IBAN_LENGTHS.get(s[:2]))
        for _, e in ends:
            if mod97(s[:e].replace(" ", "")):
                out.append((m.start(), m.start() + e))
                break
    return out


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _score(text: str, kind: str, start: int, end: int, prior: float) -> float:
    before = {w.lower() for w in WORD.findall(text[max(0, start - NEAR) : start])}
    near = before | {w.lower() for w in WORD.findall(text[end : end + NEAR // 2])}
    up, down = CONTEXT[kind]
    return round(min(1.0, max(0.0, prior + 0.3 * bool(near & up) - 0.3 * bool(before & down))), 2)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the contract's pattern finds them: the longest local part that ends at an @ and no earlier match or @ cuts."""
    free = 0
    for m in DOMAIN.finditer(text):
        at = m.start()
        begin = max(free, text.rfind("@", free, at) + 1)
        size = at - begin - len(text[begin:at].rstrip(LOCAL_PART))
        if size:
            yield at - size, m.end()
            free = m.end()
        else:
            free = at + 1


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    for m in SECRET.finditer(text):
        k = 1 if m.group(1) else 2
        if any(c.isdigit() for c in m.group(k)) and any(c.isalpha() for c in m.group(k)):
            yield m.span(k)


def _octets(address: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in address.split("."))


def find(text: str | None) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) by start and then kind; code points, end exclusive. base: one of the base kinds'. Time and
    memory are in proportion to the text, however it looks."""
    if not text:
        return []
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    digits = bool(DIGIT.search(text))
    if digits:
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if _octets(m.group())]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    out = [(k, a, b, _score(text, k, a, b, PRIOR[k]), True) for k, a, b in out]
    if digits:
        free = _gaps(out)
        out += [("iban", a, b, _score(text, "iban", a, b, PRIOR["iban"]), False) for a, b in _ibans(text)]
        out += [("secret", a, b, s, False) for a, b in _secrets(text) if (s := _score(text, "secret", a, b, PRIOR["secret"])) >= 0.5]
        for m in LOCAL_PHONE.finditer(text):
            if 7 <= len(_digits(m.group())) <= 12 and free(m.start(), m.end()) and (s := _score(text, "phone", m.start(), m.end(), PRIOR["local"])) >= 0.5:
                out.append(("phone", m.start(), m.end(), s, False))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _gaps(spans: list[tuple]):
    """A test whether a range meets none of the spans."""
    starts, ends = [], []
    for a, b in sorted((x[1], x[2]) for x in spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def free(a: int, b: int) -> bool:
        i = bisect_right(starts, a)
        return (i == 0 or ends[i - 1] <= a) and (i == len(starts) or starts[i] >= b)

    return free


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))
_NAMES = ("kind", "start", "end", "score", "base")


@freed
def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, 1 << 20):
        spans = [[dict(zip(_NAMES, x)) for x in find(t.as_py())] for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(spans, _SPAN)], ["doc_id", "spans"])


SPANS = "array<struct<kind:string,start:long,end:long,score:double,base:boolean>>"


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, spans (kind, start, end, score, base), whole texts, without a shuffle.

    Base spans are leftmost, non-overlapping per kind, confirmed and always kept, whatever their score. Null texts are empty;
    null and repeated ids come back row by row; an empty table gives no rows.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_find, f"doc_id long, spans {SPANS}")


def count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: str | None) -> str | None:
    parts, at = [], 0
    for kind, start, end, _, _ in find(text):
        if end > at:
            parts += [text[at : max(at, start)], f"<{kind.upper()}>"]
            at = end
    return "".join(parts) + text[at:] if parts else text


@freed
def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, 1 << 20):
        texts = pa.array([redacted(t.as_py()) for t in b.column("text")], pa.string())
        yield pa.RecordBatch.from_arrays([texts if c == "text" else b.column(c) for c in b.schema.names], b.schema.names)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with each span of `find` in the text replaced by its kind, as <EMAIL>; overlapping spans give such marks in a row.
    All rows and columns stay, null texts too; an empty table stays empty."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    names[docs.columns.index(text_col)] = "text"
    out = docs.toDF(*names).withColumn("text", F.col("text").cast("string"))
    return out.mapInArrow(_redact, out.schema).toDF(*docs.columns)
