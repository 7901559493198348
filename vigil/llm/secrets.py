"""Secret scan: fixed patterns, and formats learned by grammar inference.

One scan of the corpus takes from every whole text the base matches
(assignments, access keys, long hex) and the other token-like candidates.
Base matches are the labelled credentials: from a bounded sample of distinct
values per kind, red-blue state merging (ALERGIA: Carrasco and Oncina 1994)
joins the states of a prefix tree whose symbol and end frequencies do not
differ by more than the Hoeffding bound, into a probabilistic automaton per
kind.  One more automaton is learned from the other candidates.  Then every
candidate of the corpus is scored: it is a credential if its likeliest
credential format beats the automaton of ordinary candidates by ``margin``
and is about as likely per symbol as that format's own values.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import Scratch, bounded_batches

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are taken whole, so shorter ones never start inside a match
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
KINDS = ["assign", "access", "hex", "grammar"]
REST = "rest"


@dataclass(frozen=True)
class SecretRules:
    #: Distinct labelled values (by least hash) that one automaton learns from.
    sample: int = 300
    least_values: int = 20
    alpha: float = 0.05
    margin: float = math.log(1000)
    #: The bound per symbol: what this part of a format's own values falls
    #: below, less some slack.
    tail: float = 0.02
    slack: float = 0.05


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the base patterns, by start and kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, taken: list[tuple]) -> list[tuple[int, int, str]]:
    """Token-like runs with a letter and a digit, outside the base spans."""
    out = []
    for m in CANDIDATE.finditer(text):
        s = m[0]
        if any(c.isdigit() for c in s) and any(c.isalpha() for c in s) and not any(a < m.end() and m.start() < b for a, b, *_ in taken):
            out.append((m.start(), m.end(), s))
    return out


def render(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(((s[0], s[1], s[2]) for s in spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


# ------------------------------------------------------------------- automata


@dataclass
class State:
    n: int = 0
    end: int = 0
    to: dict[str, State] = field(default_factory=dict)
    count: dict[str, int] = field(default_factory=dict)


def prefix_tree(values: list[str]) -> State:
    root = State()
    for v in values:
        s = root
        s.n += 1
        for c in v:
            s.count[c] = s.count.get(c, 0) + 1
            s = s.to.setdefault(c, State())
            s.n += 1
        s.end += 1
    return root


def _differ(a: int, n: int, b: int, m: int, alpha: float) -> bool:
    return abs(a / n - b / m) > math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))


def compatible(a: State, b: State, alpha: float) -> bool:
    """Whether all frequencies below two states agree within the bound."""
    work = [(a, b)]
    while work:
        x, y = work.pop()
        if not x.n or not y.n:
            continue
        if _differ(x.end, x.n, y.end, y.n, alpha):
            return False
        for c in x.count.keys() | y.count.keys():
            if _differ(x.count.get(c, 0), x.n, y.count.get(c, 0), y.n, alpha):
                return False
            if c in x.to and c in y.to:
                work.append((x.to[c], y.to[c]))
    return True


def _fold(into: State, tree: State) -> None:
    work = [(into, tree)]
    while work:
        x, y = work.pop()
        x.n += y.n
        x.end += y.end
        for c, child in y.to.items():
            x.count[c] = x.count.get(c, 0) + y.count[c]
            if c in x.to:
                work.append((x.to[c], child))
            else:
                x.to[c] = child


def merge_states(root: State, alpha: float) -> list[State]:
    """Red-blue merging; the states that stay, the start first."""
    red, known = [root], {id(root)}
    while True:
        blue = [(s, c) for s in red for c in sorted(s.to) if id(s.to[c]) not in known]
        if not blue:
            return red
        parent, c = max(blue, key=lambda p: p[0].count[p[1]])
        b = parent.to[c]
        for r in red:
            if compatible(r, b, alpha):
                parent.to[c] = r
                _fold(r, b)
                break
        else:
            red.append(b)
            known.add(id(b))


class Automaton:
    """Probabilities of strings under merged states."""

    def __init__(self, values: list[str], rules: SecretRules):
        states = merge_states(prefix_tree(sorted(values)), rules.alpha)
        place = {id(s): i for i, s in enumerate(states)}
        alphabet = set("".join(values))
        self.unseen = math.log(1e-4 / max(1, len(alphabet)))
        self.steps: list[dict[str, tuple[int, float]]] = []
        self.ends: list[float] = []
        for s in states:
            total = s.n + 0.1 * (len(alphabet) + 1)
            self.steps.append({c: (place.get(id(s.to.get(c)), 0), math.log((s.count.get(c, 0) + 0.1) / total)) for c in sorted(alphabet)})
            self.ends.append(math.log((s.end + 0.1) / total))
        typical = sorted(self.per_symbol(v) for v in values)
        self.least = typical[int(rules.tail * len(typical))] - rules.slack

    def _walk(self, value: str) -> tuple[float, int]:
        at, total = 0, 0.0
        for c in value:
            at, p = self.steps[at].get(c, (at, self.unseen))
            total += p
        return total, at

    def score(self, value: str) -> float:
        """Log-probability of the string."""
        total, at = self._walk(value)
        return total + self.ends[at]

    def per_symbol(self, value: str) -> float:
        """Mean log-probability of its symbols, whatever its length."""
        return self._walk(value)[0] / max(1, len(value))


def fit(labelled: dict[str, list[str]], rules: SecretRules) -> dict[str, Automaton]:
    return {kind: Automaton(v, rules) for kind, v in labelled.items() if len(v) >= rules.least_values}


def is_credential(value: str, formats: dict[str, Automaton], rules: SecretRules) -> bool:
    rest = formats[REST].score(value) if REST in formats else -math.log(66) * (len(value) + 1)
    for kind, a in formats.items():
        if kind != REST and a.score(value) - rest >= rules.margin and a.per_symbol(value) >= a.least:
            return True
    return False


# ------------------------------------------------------------------- operator

FOUND = "doc_id long, base array<struct<s:int,e:int,kind:string,value:string>>, others array<struct<s:int,e:int,value:string>>"
RESULT = "doc_id long, n_assign long, n_access long, n_hex long, n_grammar long, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("s", pa.int32()), ("e", pa.int32()), ("kind", pa.string()), ("value", pa.string())])
    other = pa.struct([("s", pa.int32()), ("e", pa.int32()), ("value", pa.string())])
    for b in batches:
        base, others = [], []
        for t in b.column(1).to_pylist():
            got = base_spans(t or "")
            base.append([dict(zip(("s", "e", "kind", "value"), x)) for x in got])
            others.append([dict(zip(("s", "e", "value"), x)) for x in candidates(t or "", got)])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, pa.list_(span)), pa.array(others, pa.list_(other))], ["doc_id", "base", "others"])


def labelled_sample(found: DataFrame, rules: SecretRules) -> dict[str, list[str]]:
    """Per kind (and for the other candidates) at most ``sample`` distinct
    values, those of the least hash: at most 4 * sample strings."""
    base = found.select(F.explode("base").alias("x")).select("x.kind", "x.value")
    rest = found.select(F.explode("others").alias("x")).select(F.lit(REST).alias("kind"), "x.value")
    out = {}
    for kind in ("assign", "access", "hex", REST):
        values = (rest if kind == REST else base.where(F.col("kind") == kind)).select("value").distinct()
        rows = values.orderBy(F.xxhash64("value"), "value").limit(rules.sample).collect()
        out[kind] = sorted(r["value"] for r in rows)
    return out


def secret_spans(docs: DataFrame, rules: SecretRules = SecretRules()) -> DataFrame:
    """One row per input row: doc_id, counts per kind, base_sha256 and spans
    (``kind:start:end``, by start and kind, code points, end exclusive).

    Null and empty texts have no spans (the digest is that of the empty
    string); repeated rows are scanned alike; other columns are ignored; an
    empty table gives an empty table.  With fewer than ``least_values``
    values of every kind only base spans are returned.
    """
    bounded_batches(docs.sparkSession)
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    found = Scratch(docs.sparkSession, "secrets").save(src.mapInArrow(_scan, FOUND), "found")
    formats = fit(labelled_sample(found, rules), rules)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, base, others in zip(*(c.to_pylist() for c in b.columns)):
                own = [(x["s"], x["e"], x["kind"]) for x in base]
                more = [(x["s"], x["e"], "grammar") for x in others if is_credential(x["value"], formats, rules)]
                n = [sum(x[2] == k for x in own) for k in KINDS[:3]]
                rows.append((doc, *n, len(more), hashlib.sha256(render(own).encode()).hexdigest(), render(own + more)))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            names = ["doc_id", "n_assign", "n_access", "n_hex", "n_grammar", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return found.mapInArrow(score, RESULT)
