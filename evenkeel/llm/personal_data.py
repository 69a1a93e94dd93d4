"""Personal data in texts, by weak supervision.

Exact rules find base spans of four kinds, which always stay. Rules drop what looks odd as
a whole: a phone number before a card number is a run of too many digits. So wider
patterns propose candidates, and the votes of several labelers decide on them:

1.  Every text is read once. Its candidates, base spans among them, get a vote (for,
    against, none) of each labeler: rules, validity (checksum, ranges), gazetteers of top
    domains, calling codes and issuers, what adjoins, words for and against in the
    context, and shape.
2.  Candidates are counted by (kind, votes): at most 4 * 3 ** 7 rows, whatever the corpus.
    Expectation-maximisation over these counts estimates how each labeler votes on true
    and on false candidates, and how often a candidate of a kind is true.
3.  A logistic classifier learns the estimated probabilities from features of a sample of
    at most about ``sample`` candidates (votes, shape, neighbours, words around).
4.  Candidates that the classifier finds likelier true than not are added where they meet
    no base span and no likelier candidate.

Defined results: a null or empty text has no spans. Each row is judged by itself, also
rows that repeat an id or have none. Without candidates nothing is learned or added.
Offsets count code points; an end is exclusive.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from evenkeel.session import stage

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("rule", "validity", "gazetteer", "adjoining", "words for", "words against", "shape")

# Top-level domains, calling codes and issuer prefixes of public registries.
TOP_DOMAINS = frozenset(
    "com org net edu gov mil int info biz name pro io ai app dev me tv eu us uk ca au nz ie de at ch fr be nl lu "
    "es pt it gr se no dk fi is pl cz sk hu ro bg hr si rs ua ru tr il in cn jp kr hk tw sg my th vn id ph br mx "
    "ar cl co pe za ng ke eg ma".split())
CALLING_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 "
    "84 86 90 91 92 93 94 95 98 212 213 216 218 234 254 351 352 353 354 358 359 370 371 372 380 381 385 386 420 "
    "421 852 886 966 971 972".split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|3[068]|35|6(?:011|5|4[4-9]|2)")
WORDS_FOR = {
    "email": frozenset("mail email e-mail courriel correo contact write reply kontakt contacto schreiben".split()),
    "ip": frozenset("ip ipv4 ipv6 host server client login address adresse dirección".split()),
    "card": frozenset("card visa mastercard amex credit debit karte kreditkarte carte tarjeta pan".split()),
    "phone": frozenset("tel phone telephone call fax mobile cell telefon anruf téléphone appel teléfono móvil".split()),
}
WORDS_AGAINST = frozenset(
    "token key apikey secret password hash sha md5 uuid checksum version release v license licence isbn issn doi "
    "page fig section chapter order invoice serial article id".split())

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What candidates are proposed by; all quantifiers before an alternative are bounded.
CARD_LIKE = re.compile(
    r"(?<![0-9])(?:[0-9]{4}([\x20.-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{9,19})(?![0-9])")
PHONE_LIKE = re.compile(
    r"(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)[\x20.-]?|[0-9]{2,4}[\x20.-])"
    r"[0-9]{3,4}[\x20.-][0-9]{4}(?![0-9])")
IP_LIKE = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
SPOKEN_DOT = re.compile(r"(?i)[\[({]\x20?dot\x20?[\])}]|\x20dot\x20")
EMAIL_LIKE = re.compile(
    r"(?i)[a-z0-9._%+-]{1,64}(?:@|\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20)[a-z0-9-]{1,63}"
    r"(?:(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20)[a-z0-9-]{1,63}){1,4}")
AROUND = 160            # code points before a spoken dot that an address may begin in
CONTEXT = 48            # code points on either side whose words are read
WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)*")
DIGIT = re.compile(r"[0-9]")
SLOTS = 1 << 14


@dataclass(frozen=True)
class Learning:
    sample: int = 20_000
    rounds: int = 50      # of expectation-maximisation
    prior: float = 5.0    # votes that a labeler is taken to have cast well at the start
    epochs: int = 300
    rate: float = 0.3
    decay: float = 1e-3


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match ends at an at sign's host, so it is looked for from the signs, in one pass."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        host = HOST.match(text, at + 1) if begin < at else None
        if host:
            yield begin, host.end()
            done = host.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """A run of dotted numbers holds a match in each four of them."""
    for run in DOTTED.finditer(text):
        parts, begin = run[0].split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = begin + sum(map(len, four)) + 3
            if all(map(_small, four)):
                yield begin, end
            begin = end + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the exact rules, by kind and start."""
    found = [(0, *span) for span in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [(1, *span) for span in _ips(text)]
        for m in CARD.finditer(text):
            digits = _digits(m[0]) if m.end() - m.start() < 40 else ""
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
        if "+" in text:
            found += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def candidates(text: str) -> set[tuple[int, int, int]]:
    """Further spans that may be personal data; many are not."""
    found = set()
    for dot in SPOKEN_DOT.finditer(text):
        begin = max(0, dot.start() - AROUND)
        for m in EMAIL_LIKE.finditer(text, begin, dot.end() + AROUND):
            if m.end() >= dot.end():
                found.add((0, *m.span()))
                break
    if DIGIT.search(text):
        found |= {(2, *m.span()) for m in CARD_LIKE.finditer(text)}
        found |= {(3, *m.span()) for m in PHONE_LIKE.finditer(text)}
        found |= {(1, *m.span()) for m in DOTTED.finditer(text) if m.end() - m.start() < 64}
        if ":" in text:
            found |= {(1, *m.span()) for m in IP_LIKE.finditer(text)}
    return found


def _vote(yes: bool, no: bool = False) -> int:
    return 1 if yes else -1 if no else 0


def _validity(kind: int, span: str) -> int:
    digits = _digits(span)
    if kind == 0:
        good = re.search(r"[A-Za-z]{2,}\Z", span) is not None
    elif kind == 1:
        parts = span.split(".")
        good = ":" in span or len(parts) == 4 and all(map(_small, parts))
    elif kind == 2:
        good = 13 <= len(digits) <= 19 and luhn(digits)
    else:
        good = 9 <= len(digits) <= 15
    return _vote(good, not good)


def _gazetteer(kind: int, span: str) -> int:
    if kind == 0:
        known = re.split(r"[^A-Za-z0-9-]+", span.rstrip("])} "))[-1].lower() in TOP_DOMAINS
    elif kind == 1:
        first = span.split(".")[0]
        known = ":" in span or first.isdigit() and len(first) < 4 and 1 <= int(first) <= 223
    elif kind == 2:
        known = ISSUERS.match(_digits(span)) is not None
    elif span[0] != "+":
        return 0
    else:
        known = any(_digits(span)[:n] in CALLING_CODES for n in (1, 2, 3))
    return _vote(known, not known)


PLAIN_SHAPES = (
    re.compile(r"[^\s@]+@[^\s@]+"), re.compile(r"[0-9]{1,3}(\.[0-9]{1,3}){3}|[0-9A-Fa-f:]+"),
    re.compile(r"[0-9]{13,19}|[0-9]{4}([ -][0-9]{4}){3}"),
    re.compile(r"(\+[0-9]{1,3}[ .-])?(\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"))


def _rule(kind: int, span: str) -> int:
    """Whether the exact rule takes the span when it stands alone; no vote on forms that it does not know."""
    if kind == 0 and "@" not in span or kind == 1 and ":" in span or kind == 3 and span[0] != "+":
        return 0
    taken = (kind, 0, len(span)) in base_spans(span)
    return _vote(taken, not taken)


def votes(kind: int, start: int, end: int, text: str, before: list[str], after: list[str]) -> list[int]:
    span = text[start:end]
    beside = text[start - 1:start] + text[end:end + 1]
    glued = any(c.isalnum() or c in "_=/\\#\"'" for c in beside)
    digits = _digits(span)
    near = before[-5:] + after[:1]
    return [
        _rule(kind, span), _validity(kind, span), _gazetteer(kind, span),
        _vote(not glued, glued),
        _vote(any(w in WORDS_FOR[KINDS[kind]] for w in near)),
        _vote(False, any(w in WORDS_AGAINST for w in before[-3:])),
        _vote(PLAIN_SHAPES[kind].fullmatch(span) is not None and len(set(digits)) != 1,
              kind > 1 and len(set(digits)) == 1)]


def features(kind: int, span: str, cast: list[int], left: str, right: str,
             before: list[str], after: list[str]) -> list[int]:
    """Slots of what the classifier sees of a candidate."""
    shape = re.sub("[0-9]", "0", re.sub("[^\\W\\d_]+", "a", span))[:32]
    seen = [f"vote {name} {v}" for name, v in zip(LABELERS, cast)]
    seen += [f"shape {shape}", f"length {min(len(span), 40) // 4}", f"left {left}", f"right {right}"]
    seen += [f"before {w}" for w in before[-3:]] + [f"after {w}" for w in after[:1]]
    return sorted({xxhash.xxh32_intdigest(f"{KINDS[kind]} {x}") % SLOTS for x in seen})


def _side(text: str, at: int) -> str:
    if not 0 <= at < len(text):
        return "edge"
    c = text[at]
    return "blank" if c.isspace() else "digit" if c.isdigit() else "letter" if c.isalpha() else c


def read_text(text: str) -> list[tuple]:
    """(kind, start, end, is_base, votes as a number in base 3, features) of a text, in order."""
    base = set(base_spans(text))
    out = []
    for kind, start, end in sorted(candidates(text) | base):
        before = [w.lower() for w in WORD.findall(text, max(0, start - CONTEXT), start)]
        after = [w.lower() for w in WORD.findall(text, end, end + CONTEXT)]
        cast = votes(kind, start, end, text, before, after)
        code = 0
        for v in cast:
            code = 3 * code + v + 1
        out.append((kind, start, end, (kind, start, end) in base, code, features(
            kind, text[start:end], cast, _side(text, start - 1), _side(text, end), before, after)))
    return out


SPAN = "array<struct<kind:int,start:int,end:int,base:boolean,votes:int,features:array<int>>>"
_SPAN = pa.list_(pa.struct([
    ("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
    ("votes", pa.int32()), ("features", pa.list_(pa.int32()))]))
_NAMES = ("kind", "start", "end", "base", "votes", "features")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[dict(zip(_NAMES, x)) for x in read_text(text)] if text else []
                 for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, _SPAN)], names=["doc_id", "spans"])


def _decoded(codes: np.ndarray) -> np.ndarray:
    """Votes 0, 1, 2 (against, none, for) of each labeler."""
    places = 3 ** np.arange(len(LABELERS) - 1, -1, -1)
    return codes[:, None] // places % 3


def reliabilities(kinds: np.ndarray, codes: np.ndarray, numbers: np.ndarray, how: Learning = Learning()):
    """Expectation-maximisation over counts of (kind, votes).

    Returns the probability that such a candidate is true, the share of true candidates of
    each kind, and for each class and labeler how often it votes against, not, and for.
    """
    cast, n = _decoded(codes), numbers.astype(float)
    true = 1 / (1 + np.exp(-(cast - 1.0).sum(axis=1)))
    # What a labeler is taken to do before any vote is seen: sooner right than wrong.
    belief = how.prior * np.array([[0.45, 0.45, 0.1], [0.1, 0.45, 0.45]])
    for _ in range(how.rounds):
        weight = np.stack([n * (1 - true), n * true])
        shares = np.array([(1 + weight[1][kinds == k].sum()) / (2 + n[kinds == k].sum())
                           for k in range(len(KINDS))])
        rates = np.empty((2, len(LABELERS), 3))
        for c in (0, 1):
            for j in range(len(LABELERS)):
                seen = np.bincount(cast[:, j], weight[c], 3) + belief[c]
                rates[c, j] = seen / seen.sum()
        logit = np.log(shares / (1 - shares))[kinds]
        for j in range(len(LABELERS)):
            logit = logit + np.log(rates[1, j] / rates[0, j])[cast[:, j]]
        true = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
    return true, shares, rates


@dataclass(frozen=True)
class Classifier:
    bias: float
    weights: np.ndarray

    def probability(self, slots: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[slots].sum(), -50, 50))))


def fit(rows: list[np.ndarray], target: np.ndarray, how: Learning) -> Classifier:
    """Logistic regression on probabilities, by AdaGrad over the whole sample."""
    w, bias = np.zeros(SLOTS), 0.0
    sum_w, sum_b = np.full(SLOTS, 1e-6), 1e-6
    flat = np.concatenate(rows).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    for _ in range(how.epochs):
        off = (1 / (1 + np.exp(-(bias + np.bincount(owner, w[flat], len(rows))))) - target) / len(rows)
        grad, grad_b = np.bincount(flat, off[owner], SLOTS) + how.decay * w / len(rows), off.sum()
        sum_w, sum_b = sum_w + grad ** 2, sum_b + grad_b ** 2
        w -= how.rate * grad / np.sqrt(sum_w)
        bias -= how.rate * grad_b / np.sqrt(sum_b)
    return Classifier(float(bias), w)


def train(read: DataFrame, how: Learning = Learning()) -> Classifier:
    """The span classifier, from the candidates of all documents."""
    spans = read.select(F.explode("spans").alias("x")).select("x.*")
    counted = spans.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "votes").toPandas()
    if counted.empty:
        return Classifier(-50.0, np.zeros(SLOTS))
    kinds, codes, numbers = (counted[c].to_numpy(np.int64) for c in ("kind", "votes", "n"))
    true, _, _ = reliabilities(kinds, codes, numbers, how)
    told = dict(zip(zip(kinds.tolist(), codes.tolist()), true.tolist()))
    share = min(1.0, how.sample / int(numbers.sum()))
    picked = read.select("doc_id", F.posexplode("spans").alias("at", "x")).where(
        F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "at", "x.start", "x.features"), F.lit(1 << 20)) < share * (1 << 20)
    ).select("x.kind", "x.votes", "x.features").toPandas()
    if picked.empty:
        return Classifier(-50.0, np.zeros(SLOTS))
    picked["key"] = picked["features"].map(tuple)
    picked = picked.sort_values(["kind", "votes", "key"], kind="stable")  # whatever the order of the tasks
    target = np.array([told[k] for k in zip(picked["kind"], picked["votes"])])
    return fit([np.array(k, np.int64) for k in picked["key"]], target, how)


def chosen(spans: list, model: Classifier) -> list[tuple]:
    """(kind, start, end, is_base, probability) by kind and start: base spans, and likely ones clear of others."""
    scored = [(x["kind"], x["start"], x["end"], x["base"], model.probability(x["features"])) for x in spans]
    kept, starts, ends = [x for x in scored if x[3]], [], []
    for _, start, end, _, _ in sorted(kept, key=lambda x: x[1:3]):
        if ends and start < ends[-1]:
            ends[-1] = max(end, ends[-1])
        else:
            starts.append(start)
            ends.append(end)
    for x in sorted((x for x in scored if not x[3] and x[4] >= 0.5), key=lambda x: (-x[4], x[1] - x[2], x[:2])):
        at = bisect.bisect_left(ends, x[1] + 1)  # the first taken stretch that ends after its start
        if at == len(ends) or starts[at] >= x[2]:
            kept.append(x)
            starts.insert(at, x[1])
            ends.insert(at, x[2])
    return sorted(kept)


FOUND = "array<struct<kind:string,start:int,end:int,base:boolean,probability:double>>"


def find(docs: DataFrame, how: Learning = Learning()) -> DataFrame:
    """(doc_id, spans) of every row of docs (doc_id, text); spans by kind as listed, then start."""
    read = stage(docs.select("doc_id", "text").mapInArrow(_read, f"doc_id long, spans {SPAN}"), "candidates")
    shipped = docs.sparkSession.sparkContext.broadcast(train(read, how))

    @pandas_udf(FOUND)
    def choose(spans: pd.Series) -> pd.Series:
        return spans.map(lambda row: [
            {"kind": KINDS[k], "start": s, "end": e, "base": b, "probability": p}
            for k, s, e, b, p in chosen(list(row), shipped.value)])

    return read.select("doc_id", choose("spans").alias("spans"))
