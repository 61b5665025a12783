"""Personal data by weak supervision: labelers vote on spans, expectation-maximisation weighs them, a span classifier decides.

1. One pass over the whole texts finds the base spans (email, ip, card, phone; fixed patterns, always kept) and further
   candidate spans: masked e-mail addresses, local phone numbers, persons, identity numbers, secrets (long runs of letters
   and digits). Regex, gazetteer and context
   labelers and one for shape vote yes / no / abstain on each candidate, base spans included.
2. The vote patterns are counted over all documents; expectation-maximisation (one reliability for each kind and labeler)
   turns each pattern into a probability. There are at most 3^4 patterns a kind, so the counts are bounded.
3. Those probabilities are soft labels for a naive Bayes span classifier over hashed shape and neighbour-word features,
   summed over all documents into a table of fixed size.
4. Every candidate is classified; base spans stay whatever it says, added spans need a probability of ``accept``.

Null texts count as empty; empty texts have no span. Repeated rows are judged each for itself. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from rowjudge.llm.common import released, stored, text_of

KINDS = ("email", "ip", "card", "phone", "email_masked", "phone_local", "person", "id_number", "secret")
BASE = 4
LABELERS = ("regex", "gazetteer", "context", "shape")
FEATURES = 4096

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match begins at the start of a run of digits, so looking behind changes nothing but keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

_MASKED = re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?[\[({]\s?at\s?[\])}]\s?[A-Za-z0-9-]{1,63}"
                     r"(?:(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?)[A-Za-z0-9-]{1,63}){1,5}", re.I)
_LOCAL_PHONE = re.compile(r"(?<![0-9.+-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])")
_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}")
#: How known keys begin, and the lengths of digests in hexadecimal digits (fixed values).
_KEY_STARTS = ("sk-", "pk-", "ghp_", "gho_", "glpat-", "xoxb-", "xoxp-", "AKIA", "ASIA", "AIza", "ya29", "eyJ")
_HEX_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
_HEX = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
# Names: a capital, then letters of any script with inner capitals, apostrophes and combining accents.
_CAPITAL = "".join(map(re.escape, filter(str.isupper, map(chr, range(0x2000)))))
_NAME = rf"[{_CAPITAL}](?:['\u2019]?[^\W\d_]|[\u0300-\u036f]){{1,40}}"
#: Titles and cues before a name in English, German, French and Spanish.
_TITLES = ("Mr Mrs Ms Dr Prof Herr Herrn Frau Monsieur Madame Mademoiselle Mme Mlle Señor Señora Señorita Sr Sra Srta "
           "Don Doña").split()
_CUES = ("my name is", "signed by", "contact person", "mein name ist", "ich heiße", "unterzeichnet von", "ansprechpartner",
         "mon nom est", "je m'appelle", "je m\u2019appelle", "signé par", "mi nombre es", "me llamo", "firmado por")
_CALLED = re.compile(rf"(?:\b(?:(?:{'|'.join(_TITLES)})\.?|M\.)\x20|\b(?i:{'|'.join(_CUES)}):?\x20)({_NAME}(?:[\x20-]{_NAME}){{0,2}})")
_TITLE_PARTS = ("Mr", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Mad", "Mme", "Mlle", "Señor", "Sr", "Don ", "Don.", "Doña", "M. ")

#: Gazetteers (fixed values).
GIVEN_NAMES = frozenset("""anna anne antonio carlos charles david elena elizabeth emma eric eva francois hans helen isabel
    jack jacques james jan jean jennifer john jose joseph juan julia karen karl klaus laura linda louis lucia luis maria marie
    mark mary michael monique nancy patricia paul peter pierre richard robert sandra sarah stefan susan thomas ursula
    william wolfgang""".split())
DOMAIN_ENDS = frozenset("com org net edu gov info io de fr es uk eu us ch at it nl example test".split())

#: Words before a span that speak for or against it (fixed values).
FOR = {
    "email": {"email", "e-mail", "mail", "contact", "write"}, "ip": {"ip", "address", "host", "from"},
    "card": {"card", "visa", "mastercard", "credit", "payment"}, "phone": {"phone", "tel", "call", "mobile", "fax"},
    "email_masked": {"email", "e-mail", "mail", "contact", "write"}, "phone_local": {"phone", "tel", "call", "mobile", "fax"},
    "person": {"mr", "mrs", "ms", "dr", "prof", "name", "signed", "person", "herr", "herrn", "frau", "unterzeichnet", "heiße",
               "ansprechpartner", "monsieur", "madame", "mademoiselle", "m", "mme", "mlle", "nom", "appelle", "signé", "señor",
               "señora", "señorita", "sr", "sra", "srta", "don", "doña", "nombre", "llamo", "firmado"},
    "id_number": {"ssn", "social", "security", "id"},
    "secret": {"token", "secret", "key", "apikey", "password", "passwd", "pwd", "bearer", "credential", "credentials", "auth", "signature"},
}
AGAINST = frozenset("version isbn order page figure section chapter build price total token".split())


@dataclass(frozen=True)
class PiiConfig:
    """accept: least probability of an added span; window: characters of context on each side."""

    accept: float = 0.7
    window: int = 40
    em_rounds: int = 50
    smoothing: float = 1.0


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind. The e-mail pattern is read outwards from each @, which gives its leftmost
    matches in linear time: the local part is the whole run before the @, cut at the end of the match before."""
    found = []
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            floor = m.end()
            at = text.find("@", floor)
        else:
            at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in m.group().split("."))):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def more_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further candidates, those that overlap a base span left out."""
    found = []
    low = text.lower()
    if "at" in low and ("[" in text or "(" in text or "{" in text):
        found += [(m.start(), 4, m.end()) for m in _MASKED.finditer(text)]
    found += [(m.start(), 5, m.end()) for m in _LOCAL_PHONE.finditer(text)]
    if any(x in text for x in _TITLE_PARTS) or any(x in low for x in _CUES):
        found += [(m.start(1), 6, m.end(1)) for m in _CALLED.finditer(text)]
    found += [(m.start(), 7, m.end()) for m in _ID.finditer(text)]
    for m in _SECRET.finditer(text):
        run = m.group()
        if sum(map(run.count, "0123456789")) >= 2 and not run.replace("-", "").isdigit() and any(map(str.isalpha, run)):
            found.append((m.start(), 8, m.end()))
    return sorted(x for x in found if not any(s < x[2] and x[0] < e for s, _, e in taken)) if found else found


def votes(text: str, start: int, kind: int, end: int, window: int) -> tuple[int, list[int]]:
    """The labelers' pattern (a number in base 3, each digit vote + 1) and the classifier's features."""
    span, name = text[start:end], KINDS[kind]
    before = re.findall(r"[^\W\d_]+", text[max(0, start - window): start].lower())
    after = re.findall(r"[^\W\d_]+", text[end: end + window].lower())
    digits = _NOT_DIGIT.sub("", span)
    regex, gazetteer, context, shape = 1, 0, 0, 0
    if name in ("email", "email_masked"):
        last = re.split(r"[^A-Za-z0-9-]+", span.strip("[](){} "))[-1].lower()
        gazetteer = 1 if last in DOMAIN_ENDS else 0
        regex = 1 if re.search(r"[A-Za-z]{2,}[^A-Za-z]*$", span) else 0
        shape = 1 if len(span) <= 80 else -1
    elif name == "person":
        gazetteer = 1 if span.split()[0].lower() in GIVEN_NAMES else 0
        shape = 1 if " " in span else 0
    elif name == "ip":
        gazetteer = -1 if span.startswith("0.") else 0
        shape = -1 if text[end: end + 1] == "." and text[end + 1: end + 2].isdigit() else 1
    elif name == "card":
        gazetteer = 1 if digits[0] in "3456" else -1
        shape = 1 if len(digits) in (15, 16) else 0
    elif name == "phone":
        shape = 1 if any(c in span for c in " ()-") else 0
    elif name == "phone_local":
        gazetteer = 1 if digits[0] not in "01" and digits[3] not in "01" else -1
        shape = 1 if span[0] == "(" else 0
    elif name == "id_number":
        gazetteer = -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" else 0
        shape = -1 if len(set(digits)) == 1 else 0
    elif name == "secret":
        plain = _HEX.match(span) is not None
        regex = 1 if span.startswith(_KEY_STARTS) or plain and len(span) in _HEX_LENGTHS else -1 if span.count("/") > 1 or span.count("-") > 3 else 0
        gazetteer = 1 if text[:start].rstrip(" \"'`").endswith(("=", ":")) else 0
        share = np.array(list(Counter(span).values())) / len(span)
        bits = float(-(share * np.log2(share)).sum())  # of information a character; words have less, counters far less
        shape = 1 if bits >= 3.2 else -1 if bits < 2.5 else 0
    near = set(before[-5:])
    context = 1 if near & FOR[name] else -1 if near & AGAINST else 0
    pattern = 0
    for v in (regex, gazetteer, context, shape):
        pattern = pattern * 3 + v + 1
    outline = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", span))
    words = [f"o:{outline[:40]}", f"n:{len(span) // 4}"] + [f"b{i}:{w}" for i, w in enumerate(before[:-4:-1])] + \
            [f"a{i}:{w}" for i, w in enumerate(after[:3])]
    return pattern, sorted({xxh32_intdigest(w) % FEATURES for w in words})


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_CANDIDATE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()),
                                 ("pattern", pa.int32()), ("features", pa.list_(pa.int32()))]))
_FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, " \
         "candidates array<struct<start:int,kind:int,end:int,pattern:int,features:array<int>>>"


def _finder(keys: int, window: int):
    def find(batches):
        for batch in released(batches):
            rows = []
            for text in batch.column(keys).to_pylist():
                base = base_spans(text)
                n = Counter(k for _, k, _ in base)
                spans = sorted(base + more_spans(text, base))
                said = [(s, k, e, *votes(text, s, k, e, window)) for s, k, e in spans]
                rows.append((n[0], n[1], n[2], n[3], hashlib.sha256(_join(base).encode()).hexdigest(),
                             [dict(zip(("start", "kind", "end", "pattern", "features"), x)) for x in said]))
            cols = list(zip(*rows)) or [()] * 6
            types = [pa.int64()] * 4 + [pa.string(), _CANDIDATE]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(keys)] + [pa.array(list(c), t) for c, t in zip(cols, types)],
                names=[batch.schema.field(i).name for i in range(keys)] +
                      ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "candidates"])
    return find


def find_candidates(docs: DataFrame, cfg: PiiConfig = PiiConfig()) -> DataFrame:
    """doc_id, the counts and digest of the base spans, and all candidates with votes and features."""
    rows = docs.select(F.col("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_finder(1, cfg.window), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_FOUND}")


def reliabilities(counts: dict[tuple[int, int], int], cfg: PiiConfig = PiiConfig()) -> dict[tuple[int, int], float]:
    """Expectation-maximisation over counts of (kind, pattern): the probability that each is personal data.

    Each kind starts from its majority votes; a labeler has a distribution over its three votes for each truth."""
    out = {}
    for kind in sorted({k for k, _ in counts}):
        patterns = sorted(p for k, p in counts if k == kind)
        n = np.array([counts[kind, p] for p in patterns], float)
        said = np.array([[p // 3 ** (len(LABELERS) - 1 - j) % 3 for j in range(len(LABELERS))] for p in patterns])
        p = np.clip(0.5 + 0.2 * (said - 1).sum(1), 0.05, 0.95)
        for _ in range(cfg.em_rounds):
            prior = (n @ p + cfg.smoothing) / (n.sum() + 2 * cfg.smoothing)
            like = np.zeros((2, len(patterns)))
            for j in range(len(LABELERS)):
                for truth, weight in enumerate((n * (1 - p), n * p)):
                    share = np.bincount(said[:, j], weight, 3) + cfg.smoothing * (np.array([3, 2, 1]) if truth == 0 else np.array([1, 2, 3]))
                    like[truth] += np.log(share / share.sum())[said[:, j]]
            odds = np.log(prior / (1 - prior)) + like[1] - like[0]
            p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        out.update({(kind, pattern): float(x) for pattern, x in zip(patterns, p)})
    return out


@dataclass(frozen=True)
class SpanClassifier:
    """Log odds for each kind, and for each kind and hashed feature."""

    prior: np.ndarray
    weight: np.ndarray

    def probability(self, kind: int, features) -> float:
        odds = self.prior[kind] + self.weight[kind, list(features)].sum()
        return float(1 / (1 + np.exp(-np.clip(odds, -30, 30))))


def train(candidates: DataFrame, cfg: PiiConfig = PiiConfig()) -> SpanClassifier:
    """The classifier from the stored candidates. What reaches the driver is bounded: 9 x 81 pattern counts and 9 x 4096
    feature sums, however many documents there are."""
    each = candidates.select(F.explode("candidates").alias("c")).select("c.*")
    counts = {(r["kind"], r["pattern"]): r["count"] for r in each.groupBy("kind", "pattern").count().collect()}
    sure = reliabilities(counts, cfg)
    prior, weight = np.zeros(len(KINDS)), np.zeros((len(KINDS), FEATURES))
    if not counts:
        return SpanClassifier(prior, weight)
    p = F.create_map(*[F.lit(x) for (k, q), v in sure.items() for x in (k * 81 + q, v)])[F.col("kind") * 81 + F.col("pattern")]
    sums = each.select("kind", p.alias("p"), F.explode(F.concat(F.array(F.lit(-1)), "features")).alias("f")) \
        .groupBy("kind", "f").agg(F.sum("p").alias("yes"), F.count("*").alias("n")).toPandas()
    for kind, own in sums.groupby("kind"):
        total = own[own.f == -1].iloc[0]
        yes, no = total.yes, total.n - total.yes
        prior[kind] = np.log((yes + cfg.smoothing) / (no + cfg.smoothing))
        own = own[own.f >= 0]
        # smoothed towards the feature's rate in both classes, so that a class with few spans says little about rare features
        rate = cfg.smoothing * own.n / total.n
        weight[kind, own.f] = np.log((own.yes + rate) / (yes + cfg.smoothing)) - np.log((own.n - own.yes + rate) / (no + cfg.smoothing))
    return SpanClassifier(prior, weight)


def classify(candidates: DataFrame, model: SpanClassifier, cfg: PiiConfig = PiiConfig()) -> DataFrame:
    """Adds ``spans``: array<struct<kind, start, end, probability>> of the base spans and the accepted ones."""
    def decide(series: pd.Series) -> pd.Series:
        out = []
        for row in series:
            kept = []
            for c in row:
                p = model.probability(c["kind"], c["features"])
                if c["kind"] < BASE or p >= cfg.accept:
                    kept.append({"kind": KINDS[c["kind"]], "start": c["start"], "end": c["end"], "probability": p})
            out.append(kept)
        return pd.Series(out)

    decide.__annotations__ = {"series": pd.Series, "return": pd.Series}
    udf = F.pandas_udf(decide, "array<struct<kind:string,start:int,end:int,probability:double>>")
    return candidates.withColumn("spans", udf("candidates")).drop("candidates")


def find_pii(docs: DataFrame, cfg: PiiConfig = PiiConfig()) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and ``spans`` of every document."""
    candidates = stored(find_candidates(docs, cfg), "pii")
    return classify(candidates, train(candidates, cfg), cfg)


def redact(docs: DataFrame, cfg: PiiConfig = PiiConfig()) -> DataFrame:
    """``docs`` with each span of its text replaced by its kind in brackets; texts without a span stay as they are.

    The spans are found again in the pass that replaces them, which spares a join of texts; the model is trained first."""
    model = train(stored(find_candidates(docs, cfg), "pii"), cfg)

    def masked(text: str | None) -> str | None:
        if not text:
            return text
        base = base_spans(text)
        extra = [x for x in more_spans(text, base)
                 if model.probability(x[1], votes(text, *x, cfg.window)[1]) >= cfg.accept]
        parts, done, until = [], 0, -1
        for s, k, e in sorted(base + extra):
            if s >= until:  # one that overlaps the span before is covered by that one's mark
                parts += [text[done:s], f"[{KINDS[k].upper()}]"]
            until = done = max(e, until)
        return "".join(parts) + text[done:]

    def replace(texts):
        for series in released(texts):
            yield pd.Series([masked(text) for text in series], dtype=object)

    replace.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn("text", F.pandas_udf(replace, "string")("text"))


def spans_text(spans: str) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
