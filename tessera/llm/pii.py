"""Personal data in texts: spans by rule, and those that a linear-chain conditional random field adds.

The rules (pii_rules) know the plain forms. The field finds what they can't: telephone numbers without +,
addresses written out or torn ("jane dot doe (at) example (dot) org"), IP addresses with guarded dots,
card numbers with other separators or of 15 digits. It reads each neighbourhood of a digit, an @ or the
word dot: 40 characters to either side within the line, neighbourhoods that touch being one. A word cut by
its edge counts as far as it lies in it. What it labels is kept where it touches no rule's span and no
letter or digit and passes the kind's own check (digits, Luhn, parts of an address).

It is trained from a small labelled table, at most `limit` rows, by default one that is written out here
from forms of each kind and of dates, amounts, versions, orders, hexadecimal strings and such between
invented words.

Defined cases: a null text is empty and has no spans; texts of any length are read whole, one at a time;
repeated rows each give a row; a null doc_id stays null; an empty table gives no rows; other columns pass
only if asked for by `keep`.
"""

from __future__ import annotations

import hashlib
import random
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import crf
from .common import sliced
from .pii_rules import KINDS, base_spans, digits_of, ip_parts_ok, luhn

MARGIN = 40
_CUE = re.compile(r"[0-9@]+")
_DOTS = ("dot", "Dot", "DOT")
_LABELLED = "text string, spans array<struct<kind:string,start:int,stop:int>>"
_NAMES = "anna ben carla david elena felix gina hugo ines jonas karin luis marta nils olga pavel rosa sven tina uwe vera".split()
_PLACES = "example mailbox netpost inbox webfarm posthaus correo mail5 hostly acme".split()


# --- labelled rows -------------------------------------------------------------------------------
class _Writer:
    """Labelled lines from a seed."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        parts = "an ber ción de eau er gen ha in la men nd on ou que ré st th tion ung ver wh ñ é ö".split()
        w = "".join(self.r.choice(parts) for _ in range(self.r.randint(1, 4)))
        return self.r.choice((w, w, w, w.capitalize(), w.upper())) + self.r.choice(("", "", "", "", ",", ".", "!", "***"))

    def common(self) -> str:
        return self.r.choice("the a at of to and in on is was dot we you please or for by as it meet sold see point com net".split())

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def card(self, n: int = 16) -> str:
        head = self.r.choice(("4", "51", "37", "6011")) if n != 15 else "37"
        body = head + self.digits(n - len(head) - 1)
        return next(body + d for d in "0123456789" if luhn(body + d))

    def cue(self, *words: str) -> str:
        return self.r.choice(words) + self.r.choice((" ", ": ", " is ", " ", " no. ", " number "))

    def phone(self) -> tuple[str, str]:
        r, d = self.r, self.digits
        strong = r.choice((f"({d(3)}) {d(3)}-{d(4)}", f"({d(3)}){d(3)}-{d(4)}", f"1-{d(3)}-{d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"({d(3)}) {d(3)} {d(4)}"))
        weak = r.choice((f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"{d(3)}-{d(4)}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", f"0{d(2)}/{d(7)}", f"0049 {d(2)} {d(7)}", f"0{d(2)} {d(7)}", d(10), f"00 44 {d(2)} {d(4)} {d(4)}", f"9{d(2)} {d(3)} {d(3)}"))
        cue = self.cue("phone", "tel", "Tel.", "telephone", "call", "Call", "fax", "mobile", "cell", "ring", "Telefon", "teléfono", "dial")
        return r.choice((("", strong), (cue, strong), (cue, weak), (cue, weak)))

    def email(self) -> tuple[str, str]:
        r = self.r
        at, dot = r.choice(((" at ", " dot "), (" AT ", " DOT "), (" (at) ", " (dot) "), ("(at)", "(dot)"), (" [at] ", " [dot] "), ("[at]", "[dot]"), (" at ", " dot ")))
        user = r.choice(_NAMES) + r.choice(("", f"{dot}{r.choice(_NAMES)}", f".{r.choice(_NAMES)}", self.digits(2), "." + self.digits(2)))
        host = r.choice(_PLACES)
        host += r.choice(("", "", f"{dot}{r.choice(_PLACES)}"))
        tld = r.choice("com org net edu io de fr es info".split())
        torn = r.choice((f"{user.replace(dot, '.')}@ {r.choice(_PLACES)}.{tld}", f"{user.replace(dot, '.')} @ {r.choice(_PLACES)}.{tld}", f"{user.replace(dot, '.')} @{r.choice(_PLACES)}.{tld}"))
        cue = r.choice(("", "", self.cue("email", "mail", "contact", "reach me at", "write to")))
        return cue, r.choice((f"{user}{at}{host}{dot}{tld}", f"{user}{at}{host}{dot}{tld}", torn))

    def ip(self) -> tuple[str, str]:
        r = self.r
        parts = [str(r.randint(0, 255)) for _ in range(4)]
        seps = r.choice((["[.]"] * 3, ["(.)"] * 3, [" dot "] * 3, [".", ".", "[.]"], ["[.]", ".", "."], ["[dot]"] * 3, [" . "] * 3))
        return r.choice(("", self.cue("ip", "IP", "host", "address", "server", "gateway"))), parts[0] + "".join(s + p for s, p in zip(seps, parts[1:]))

    def card_text(self) -> tuple[str, str]:
        r = self.r
        cue = r.choice(("", self.cue("card", "visa", "Visa", "credit card", "amex", "paid with")))
        if r.random() < 0.35:
            c = self.card(15)
            return self.cue("card", "amex", "Amex", "credit card", "paid with"), r.choice((c, f"{c[:4]} {c[4:10]} {c[10:]}", f"{c[:4]}-{c[4:10]}-{c[10:]}"))
        c = self.card()
        sep = r.choice((".", "/", "_", " - ", "  ", ". ", ":"))
        return cue, sep.join(c[i : i + 4] for i in range(0, 16, 4))

    def other(self) -> str:
        r, d = self.r, self.digits
        hexes = "".join(r.choice("0123456789abcdef") for _ in range(r.choice((8, 16, 32, 40))))
        uuid = "-".join("".join(r.choice("0123456789abcdef") for _ in range(n)) for n in (8, 4, 4, 4, 12))
        return r.choice((
            f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}", f"{r.randint(1, 12)}/{r.randint(1, 28)}/{r.randint(1990, 2030)}", f"{d(2)}.{d(2)}.{r.randint(1990, 2030)}", f"version {d(1)}.{d(2)}.{d(1)}", f"v{d(1)}.{d(1)}",
            f"order {d(3)}-{d(4)}", f"order no. {d(10)}", f"invoice {d(4)}-{d(4)}", f"isbn 978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"pages {d(3)}-{d(3)}", f"${d(1)},{d(3)}.{d(2)}", f"{d(2)}.{d(1)}%", f"{d(2)}:{d(2)}", f"{d(2)}:{d(2)}:{d(2)}", f"{d(1)} {d(3)} {d(3)}",
            f"{d(2)}.{d(3)}, {d(2)}.{d(3)}", f"score {d(1)}-{d(1)}", f"room {d(3)}", d(r.randint(1, 12)), f"token = \"{hexes}\"", hexes, uuid, f"[{d(1)}]", f"[{d(2)}], [{d(2)}]", f"serial {d(4)}-{d(4)}-{d(4)}", f"section {d(1)}.{d(1)}.{d(2)}.", f"from {d(3)} to {d(3)}", f"@{r.choice(_NAMES)}", f"@media print",
            f"part {d(3)}.{d(3)}.{d(4)}", f"id {d(3)} {d(3)} {d(4)}", f"ref {d(4)}.{d(4)}.{d(4)}.{d(4)}", f"account no {d(10)}", f"the dot com boom of {d(4)}", f"at {d(1)} dot {d(1)} percent", f"sold at {d(1)}.{d(2)}", f"meet at {self.word()} dot {self.word()}", f"a dot at the end", f"model {d(3)}-{d(3)}-{d(4)}", f"lot 0{d(2)}/{d(7)}",
            f"{d(16)}", f"{d(4)} {d(4)} {d(4)} {d(4)}", f"{r.choice(_NAMES)}.{d(2)}@{r.choice(_PLACES)}.com", f"+{d(1)} ({d(3)}) {d(3)}-{d(4)}", f"{d(3)}.{d(2)}.{d(3)}.{d(2)}", f"{d(3)} {d(3)} {d(3)} {d(3)} {d(3)}", f"{d(2)} x {d(2)} x {d(2)}", f"{d(3)}, {d(3)}, {d(4)}",
        ))

    def line(self) -> tuple[str, list[tuple[str, int, int]]]:
        out, spans = "", []
        fill = lambda: " ".join(self.common() if self.r.random() < 0.3 else self.word() for _ in range(self.r.randint(0, 5)))
        for _ in range(self.r.randint(1, 3)):
            out += fill()
            out += " " if out and not out.endswith(" ") else ""
            pick = self.r.random()
            if pick < 0.5:
                out += self.other()
            else:
                kind = self.r.choice(KINDS)
                cue, value = {"phone": self.phone, "email": self.email, "ip": self.ip, "card": self.card_text}[kind]()
                out += cue
                spans.append((kind, len(out), len(out) + len(value)))
                out += value
            out += self.r.choice((" ", " ", " ", ", ", ". ", "! ", "; "))
        return out + fill(), spans


def labelled_examples(spark: SparkSession, rows: int = 1000, seed: int = 7) -> DataFrame:
    """(text, spans) written out from a seed: the default training table."""
    w = _Writer(seed)
    return spark.createDataFrame([w.line() for _ in range(rows)], _LABELLED)


def train(labelled: DataFrame, limit: int = 5000) -> crf.Model:
    """The field learned from at most `limit` labelled rows(text, spans)."""
    rows = [(r["text"], [tuple(s) for s in r["spans"] or []]) for r in labelled.select("text", "spans").where("text is not null").limit(limit).collect()]
    return crf.train([x for x, _ in rows], [s for _, s in rows], KINDS)


# --- decoding ------------------------------------------------------------------------------------
def neighbourhoods(text: str) -> list[tuple[int, int]]:
    """Stretches of a line around what personal data can't be without."""
    cues = [m.span() for m in _CUE.finditer(text)]
    for dot in _DOTS:
        at = text.find(dot)
        while at >= 0:
            if not text[at - 1 : at].isalpha() and not text[at + 3 : at + 4].isalpha():
                cues.append((at, at + 3))
            at = text.find(dot, at + 3)
    out: list[list[int]] = []
    for a, b in sorted(cues):
        if out and a - MARGIN <= out[-1][1] and text.find("\n", out[-1][2], a) < 0:
            out[-1][1], out[-1][2] = max(out[-1][1], b + MARGIN), b
        else:
            out.append([a - MARGIN, b + MARGIN, b, a])
    found = []
    for a, b, last, first in out:
        a, b = max(a, 0, text.rfind("\n", max(a, 0), first) + 1), min(b, len(text))
        end = text.find("\n", last, b)
        found.append((a, b if end < 0 else end))
    return found


def _plausible(kind: str, value: str) -> bool:
    digits = digits_of(value)
    if kind == "phone":
        return 7 <= len(digits) <= 15 and len(set(digits)) > 1
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "ip":
        return ip_parts_ok(re.findall(r"[0-9]+", value))
    return sum(c.isalpha() for c in value) >= 5


def _free(text: str, a: int, b: int) -> bool:
    return not (text[a - 1 : a].isalnum() if a else False) and not text[b : b + 1].isalnum()


def added_spans(texts: list[str], base: list[list[tuple[str, int, int]]], model: crf.Model) -> list[list[tuple[str, int, int]]]:
    """What the field adds to each text's base spans, all texts' neighbourhoods at once."""
    places, pieces, offset, starts = [], [], 0, []
    for i, text in enumerate(texts):
        for a, b in neighbourhoods(text):
            places.append((i, a))
            pieces.append(text[a:b])
            starts.append(offset)
            offset += b - a + 1
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if not pieces:
        return out
    t = crf.tokenize("\n".join(pieces))
    labels = crf.decode(model, t)
    where = 0
    for kind, a, b in crf.spans_of(labels, t, model.kinds):
        while where + 1 < len(starts) and starts[where + 1] <= a:
            where += 1
        i, shift = places[where][0], places[where][1] - starts[where]
        a, b = a + shift, b + shift
        text = texts[i]
        if _free(text, a, b) and _plausible(kind, text[a:b]) and all(b <= x or y <= a for _, x, y in base[i]):
            out[i].append((kind, a, b))
    return out


_OUT = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_added", T.LongType())])


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def find_personal_data(docs: DataFrame, model: crf.Model | None = None, keep: tuple[str, ...] = ("doc_id",), slice_chars: int = 500_000) -> DataFrame:
    """keep, counts of the base spans by kind, base_sha256, spans (kind:start:end of base and added ones, comma-joined) and n_added of docs(text)."""
    model = model or train(labelled_examples(docs.sparkSession))
    kept = docs.select(*keep, F.col("text"))
    schema = T.StructType([kept.schema[c] for c in keep] + _OUT.fields)

    def run(batches):
        for batch in sliced(batches, 256):
            column, rows = batch.column(batch.num_columns - 1), []
            texts, chars = [], 0

            def flush():
                base = [base_spans(x) for x in texts]
                for b, more in zip(base, added_spans(texts, base, model)):
                    rows.append((*[sum(s[0] == k for s in b) for k in KINDS], hashlib.sha256(_joined(b).encode()).hexdigest(), _joined(b + more), len(more)))

            for value in column:
                texts.append(value.as_py() or "")
                chars += len(texts[-1])
                if chars > slice_chars:
                    flush()
                    texts, chars = [], 0
            flush()
            made = [pa.array(list(v), pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for v, f in zip(zip(*rows) if rows else [[]] * len(_OUT), _OUT)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(batch.num_columns - 1)], *made], names=schema.names)

    return kept.mapInArrow(run, schema)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """text with <kind> in place of each span; overlapping ones are one, named by the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join(out) + text[at:]
