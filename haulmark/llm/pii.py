"""Personal data by weak supervision.

Base spans (mail, ip, card, phone) follow fixed rules and always stay. Beside them, wider candidates
are found: secrets, numbers, spelt-out mail addresses and names. Regex, gazetteer and context
labelers vote on every candidate or abstain; expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is, and a span classifier trained on the resulting
probabilities decides which candidates are added.

To the driver go the counts of vote patterns (at most `2 * 3^labelers`) and a sample of spans of
documented size; each text is searched whole, in time linear in its length.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import first_by_hash, written

BASE = ("email", "ip", "card", "phone")
ADDED = ("email", "name", "number", "secret")
KINDS = ("email", "ip", "card", "phone", "name", "number", "secret")

Span = tuple[int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a failed number start means that starts further on in the same digits fail too
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> list[Span]:
    """Addresses, leftmost and not overlapping: around each @ the run before it and the domain behind."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _is_ip(text: str) -> bool:
    return all(int(x.lstrip("0")[:4] or 0) <= 255 for x in text.split("."))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of each base kind in order; a match that fails its check is dropped without a retry."""
    checked = lambda pattern, test: [m.span() for m in pattern.finditer(text) if test(m[0])]
    return {"email": emails(text), "ip": checked(IP, _is_ip), "card": checked(CARD, _is_card), "phone": checked(PHONE, _is_phone)}


def joined(spans: dict[str, list[Span]]) -> str:
    """`kind:start:end` by kind and start, joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans.get(k, ())))


# candidates beside the base spans

SECRET = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{16,}+")
NUMBER = re.compile(r"(?<![0-9A-Za-z+])[0-9][0-9 ().-]{5,}[0-9](?![0-9A-Za-z])")
SPELT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++)++")
NAME = re.compile(r"(?<!\w)(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora|Name:)\.? [A-Z]\w++(?: [A-Z]\w++){0,2}+")

# fixed lists of the gazetteer and context labelers
SECRET_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk_", "pk_", "xoxb", "xoxp", "eyJ", "AIza")
TOP_LEVEL = frozenset("com org net edu gov io de fr es uk eu info biz co us ch at".split())
GIVEN = frozenset(
    "anna maria john james peter paul mary michael thomas laura julia sophie marie pierre jean luc hans klaus petra "
    "carlos jose juan ana carmen elena david daniel sarah emma lucas martin andrea stefan".split()
)
FOR = re.compile(
    r"token|key|secret|passw|pwd|credential|auth|bearer|phone|tel|fon|mobil|call|fax|mail|contact|kontakt|account|konto|card|iban|ssn|passport|address|name|mr|mrs|dear",
    re.IGNORECASE,
)
AGAINST = re.compile(r"version|isbn|issn|doi|figure|table|page|chapter|commit|sha|md5|http|www|price|year|since|until|id=", re.IGNORECASE)
STRICT_NUMBER = re.compile(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{4}(?:[ -][0-9]{4}){3}|0[0-9]{2,4}[ /-][0-9]{6,8}")
HEX = re.compile(r"[0-9a-f]{32,}|[0-9A-F]{32,}")
YEARS = re.compile(r"(?:1[89]|20)[0-9]{2}[ .-]+(?:1[89]|20)[0-9]{2}|[0-9]{1,2}[.-][0-9]{1,2}[.-][0-9]{2,4}|[0-9]{4}-[0-9]{2}-[0-9]{2}")
LABELERS = ("regex", "gazetteer", "context for", "context against", "shape")
CONTEXT = 24


def _entropy(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def votes(kind: str, value: str, before: str, base: bool) -> list[int]:
    """Votes of the labelers: 0 not personal, 1 abstains, 2 personal."""
    digits = sum(c.isdigit() for c in value)
    regex, gazetteer, shape = 2 if base else 1, 1, 1
    if kind == "secret":
        regex = 2 if HEX.fullmatch(value) else 0 if value.isalpha() else 1
        gazetteer = 2 if value.startswith(SECRET_PREFIXES) else 1
        shape = 2 if digits and not value.isdigit() and _entropy(value) >= 3.2 else 0
    elif kind == "number":
        regex = 2 if STRICT_NUMBER.fullmatch(value) else 0 if YEARS.fullmatch(value) else 1
        shape = 2 if 9 <= digits <= 19 else 0
    elif kind == "name":
        gazetteer = 2 if any(w.lower() in GIVEN for w in value.split()) else 1
        shape = 2 if len(value.split()) > 2 else 1
    elif kind == "email":
        regex = 2
        gazetteer = 2 if re.split(r"[. )\]]", value.rstrip(")]"))[-1].lower() in TOP_LEVEL else 0
    context_for = 2 if FOR.search(before) else 1
    context_against = 0 if AGAINST.search(before) else 1
    return [regex, gazetteer, context_for, context_against, shape]


def _code(found: list[int]) -> int:
    return sum(v * 3**k for k, v in enumerate(found))


def _shape(kind: str, value: str, before: str) -> list[float]:
    """What the span classifier sees."""
    n = len(value)
    return [
        *(float(kind == k) for k in KINDS),
        min(n, 80) / 40,
        sum(c.isdigit() for c in value) / n,
        sum(c.isupper() for c in value) / n,
        sum(not c.isalnum() for c in value) / n,
        _entropy(value) / 5,
        float(bool(FOR.search(before))),
        float(bool(AGAINST.search(before))),
        float(before.rstrip(" \"'").endswith(("=", ":"))),
    ]


SHAPE = len(_shape("ip", "1", ""))


def _mixed(value: str) -> bool:
    return any(map(str.isalpha, value)) and any(map(str.isdigit, value))


def candidates(text: str, base: dict[str, list[Span]]) -> list[tuple[str, int, int, bool, int, list[float]]]:
    """(kind, start, end, base, votes, shape) of the base spans and of all candidates clear of them."""
    taken = sorted(x for spans in base.values() for x in spans)
    found = [(k, a, b, True) for k in BASE for a, b in base[k]]
    for kind, pattern in (("email", SPELT), ("secret", SECRET), ("number", NUMBER), ("name", NAME)):
        spans, k = [m.span() for m in pattern.finditer(text) if kind != "secret" or _mixed(m[0])], 0
        for a, b in spans:
            while k < len(taken) and taken[k][1] <= a:
                k += 1
            if k == len(taken) or taken[k][0] >= b:
                found.append((kind, a, b, False))
        taken = sorted([*taken, *((a, b) for kind_, a, b, _ in found if kind_ == kind)])
    out = []
    for kind, a, b, is_base in found:
        value, before = text[a:b], text[max(0, a - CONTEXT) : a]
        out.append((kind, a, b, is_base, _code(votes(kind, value, before, is_base)), _shape(kind, value, before)))
    return out


def fit_labelers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each pattern to be personal, and the reliability of each labeler.

    Votes of labelers are independent given the truth; a labeler that votes is right with its
    reliability, which starts at 0.8, is held there by a twentieth of the spans, and stays above one half.
    """
    voted, positive = patterns != 1, patterns == 2
    right, prior, weight = np.full(patterns.shape[1], 0.8), 0.5, counts.astype(float)
    held = 0.05 * weight.sum() + 1
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + np.where(voted, np.where(positive, 1, -1), 0) @ np.log(right / (1 - right))
        belief = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        agree = np.where(positive, belief[:, None], 1 - belief[:, None]) * voted
        right = (weight @ agree + 0.8 * held) / (weight @ voted + held)
        right = np.clip(right, 0.55, 0.99)
        prior = float(np.clip((weight @ belief + 1) / (weight.sum() + 2), 0.05, 0.95))
    return belief, right


def fit_spans(shapes: np.ndarray, belief: np.ndarray, rounds: int = 500) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels."""
    weight, bias = np.zeros(shapes.shape[1]), 0.0
    for _ in range(rounds):
        pull = 1 / (1 + np.exp(-np.clip(shapes @ weight + bias, -30, 30))) - belief
        weight -= 1.0 * (shapes.T @ pull / len(pull) + 1e-4 * weight)
        bias -= 1.0 * pull.mean()
    return weight, float(bias)


CANDIDATE = "struct<kind:string,start:int,end:int,base:boolean,votes:int,shape:array<double>>"


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = 20_000) -> DataFrame:
    """One row per document: key, base (array of kind, start, end), base_text, spans (added ones too).

    Result columns: key, n_email, n_ip, n_card, n_phone (base spans), base_text and spans
    (`joined` forms), base_sha256, n_added (spans beside the base ones). Places are code points, ends
    exclusive. The span classifier learns from the `sample` spans first by hash, equal ones once;
    reliabilities come from all spans. A name is a title and up to three words of any length. Null and empty texts
    have no spans; repeated rows stay repeated; an empty table gives no rows; other columns are
    ignored. Without any candidate nothing is learnt and nothing added.
    """
    kind = docs.schema[key].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE)

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch[text]:
                base = base_spans(t or "")
                line = joined(base)
                rows.append((*(len(base[k]) for k in BASE), line, hashlib.sha256(line.encode()).hexdigest(), candidates(t or "", base)))
            names = [*(f"n_{k}" for k in BASE), "base_text", "base_sha256", "candidates"]
            out = pd.DataFrame(rows, columns=names, index=batch.index)
            out["candidates"] = [[dict(zip(("kind", "start", "end", "base", "votes", "shape"), x, strict=True)) for x in c] for c in out["candidates"]]
            yield pd.concat([batch[[key]], out], axis=1)

    schema = f"`{key}` {kind}, {counts}, base_text string, base_sha256 string, candidates array<{CANDIDATE}>"
    table = written(docs.select(key, text).mapInPandas(searched, schema), "candidates")

    each = table.select(key, F.inline("candidates"))
    found = each.groupBy("votes").count().collect()
    model = (np.zeros(SHAPE), -math.inf)
    if found:
        codes = np.array([r["votes"] for r in found], np.int64)
        patterns = codes[:, None] // 3 ** np.arange(len(LABELERS)) % 3
        belief, _ = fit_labelers(patterns, np.array([r["count"] for r in found]))
        known = dict(zip(codes.tolist(), belief.tolist(), strict=True))
        drawn = each.select(key, "kind", "start", "end", "votes", "shape")
        chosen = first_by_hash(drawn, sample, F.xxhash64(*drawn.columns)).select("votes", "shape").collect()
        chosen.sort()  # sums of floats depend on the order
        model = fit_spans(np.array([r["shape"] for r in chosen]), np.array([known[r["votes"]] for r in chosen]))
    table = table.withColumn("spans", _decided(*model)("candidates")).drop("candidates")
    n_spans = F.when(F.col("spans") == "", 0).otherwise(F.size(F.split("spans", ",")))
    return table.withColumn("n_added", (n_spans - sum(F.col(f"n_{k}") for k in BASE)).cast("long"))


def _decided(weight: np.ndarray, bias: float):  # noqa: ANN202
    """UDF from the candidates of a text to the joined spans: base ones and those the classifier takes."""

    @F.pandas_udf("string")
    def decided(column: pd.Series) -> pd.Series:
        out = []
        for found in column:
            kept: dict[str, list[Span]] = {}
            for x in found:
                if x["base"] or float(np.dot(x["shape"], weight)) + bias >= 0:
                    kept.setdefault(x["kind"], []).append((x["start"], x["end"]))
            out.append(joined(kept))
        return pd.Series(out, dtype=object)

    return decided
