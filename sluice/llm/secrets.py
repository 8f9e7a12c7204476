"""Secret scans: patterns propose candidates, a random forest trained from labelled findings removes false ones."""

from __future__ import annotations

import math
import random
import re
import string
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import held, slices

#: Known token formats, by the shapes that their issuers publish: how they begin, and what follows.
SHAPES = (
    ("(?:AKIA|ASIA)", r"[0-9A-Z]{16}\b"), ("gh[pousr]_", r"[A-Za-z0-9]{36}\b"), ("github_pat_", r"[A-Za-z0-9_]{22,}"), ("glpat-", r"[A-Za-z0-9_\-]{20,}"), ("sk-", r"[A-Za-z0-9_\-]{20,}"),
    ("[rs]k_live_", r"[A-Za-z0-9]{16,}"), ("xox[abprs]-", r"[A-Za-z0-9\-]{10,}"), ("AIza", r"[0-9A-Za-z_\-]{35}"), ("npm_", r"[A-Za-z0-9]{36}\b"), ("eyJ", r"[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}"),
)
FORMATS = re.compile("|".join(rf"\b{begin}{rest}" for begin, rest in SHAPES))
_KEY = r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
#: A whole key up to its last line, headers of encrypted ones included; without a last line, what looks like its body.
_PEM = rf"{_KEY}(?:[^-]*(?:-(?!----)[^-]*)*-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----|(?:\s+[A-Za-z0-9+/=]{{16,}})*)"
CANDIDATE = re.compile(rf"(?P<pem>{_PEM})|(?P<fmt>" + FORMATS.pattern + r")|(?i:(?P<key>pass(?:word|wd)?|pwd|secret|token|api[_\-]?key|access[_\-]?key|auth|credential)s?)(?:[ \t]*[:=][ \t]*[\"']?)(?P<val>[^\s\"'<>]{8,})|(?P<raw>(?<![A-Za-z0-9+/_=\-.:])(?=[A-Za-z+/_=\-.:]*[0-9])[A-Za-z0-9+/_=\-.:]{20,})")
#: What each alternative above must hold: a text without any of it has no candidate.
HINT = re.compile("|".join(["[0-9:=]", "-----BEGIN", *(begin for begin, _ in SHAPES)]))
NEAR = re.compile(r"(?i)pass(word|wd)?|pwd|secret|token|api|key|auth|credential|login|bearer|private")
FALSE_NEAR = re.compile(r"(?i)sha(1|256|512)?|md5|uuid|guid|commit|checksum|digest|etag|example|sample|dummy|placeholder|version|revision|isbn|doi|page|url")
PLACEHOLDER = re.compile(r"(?i)x{4,}|\*{3,}|\.{3,}|example|changeme|your[_\-]|dummy|sample|placeholder|test|0{6,}|1234567|abcdef")
#: Everyday and code words whose share of a candidate speaks against a secret.
DICTIONARY = tuple("about after again allow apple array basic before begin between block build cache change check child class clean client close code column config content copy count create current data date debug default delete detail device document download element email empty error event example false field file filter first fixed folder format from function global google group handle header height hidden home host html image import index info input instance internal item json label language layer left length level library light line link list load local login long main manager message method model module mouse name network node null number object offset open option order output package page param parent password path people place plugin point port post prefix private process project property public query random read record release remote remove request reset result return right root sample save schema screen search second section select server service session setting shape simple size small source start state static status stop store string style submit system table target task template test text thread time title token total track true type undefined unique unit update upload user utils value version video view widget width window word work world write year".split())
_WORDS = re.compile("|".join(sorted(DICTIONARY, key=len, reverse=True)))
FEATURES = ("length", "entropy", "digit_share", "upper_share", "lower_share", "symbol_share", "class_changes", "hex_only", "transitions", "rare_bigrams", "dictionary_share", "path", "uuid", "known_format", "placeholder", "near_key", "near_false", "assigned")
_UUID = re.compile(r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
#: The most labelled findings that training reads.
MAX_FINDINGS = 6000
#: Bytes of text that are searched at once, or one text.
SLICE = 2 << 20
#: Of each ASCII character its kind: digit, lower, upper, other; whether it is a vowel; whether it is a hexadecimal digit.
_KIND = np.array([0 if chr(c).isdigit() else 1 if chr(c).islower() else 2 if chr(c).isupper() else 3 for c in range(128)])
_VOWEL = np.array([chr(c) in "aeiouyAEIOUY" for c in range(128)])
_HEX = np.array([chr(c) in string.hexdigits for c in range(128)])


def _codes(value: str) -> np.ndarray:
    """Characters as numbers; those beyond ASCII are 127."""
    return np.minimum(np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32), 127).astype(np.int64)


def transitions(values: list[str], labels: list[int]) -> np.ndarray:
    """For each character and the next one, the log of how much likelier the step is in secrets than in false findings."""
    counts = np.ones((2, 128, 128))
    for value, label in zip(values, labels):
        c = _codes(value)
        np.add.at(counts[label], (c[:-1], c[1:]), 1)
    p = counts / counts.sum(axis=2, keepdims=True)
    return np.log(p[1]) - np.log(p[0])


def features(value: str, before: str, after: str, known: bool, assigned: bool, steps: np.ndarray) -> list[float]:
    """Numbers that describe one whole candidate, in the order of FEATURES; before and after are the words beside it."""
    c = _codes(value)
    n, kinds = len(c), _KIND[c]
    share = np.bincount(c) / n
    share = share[share > 0]
    by_kind = np.bincount(kinds, minlength=4) / n
    letters = c[(kinds == 1) | (kinds == 2)]
    rare = _VOWEL[letters[:-1]] == _VOWEL[letters[1:]]
    covered = sum(len(m) for m in _WORDS.findall(value.lower()))
    return [
        float(min(n, 400)), float(-(share * np.log2(share)).sum()), by_kind[0], by_kind[2], by_kind[1], by_kind[3],
        float((kinds[:-1] != kinds[1:]).sum()) / max(n - 1, 1), float(_HEX[c].all()), float(steps[c[:-1], c[1:]].sum()) / max(n - 1, 1), float(rare.sum()) / max(len(letters) - 1, 1), covered / n,
        float(value.count("/") + value.count(".") >= 2 or "://" in value or value.startswith("/")), float(bool(_UUID.match(value))), float(known), float(bool(PLACEHOLDER.search(value))),
        float(bool(NEAR.search(before))), float(bool(FALSE_NEAR.search(before) or FALSE_NEAR.search(after))), float(assigned),
    ]


def spans(text: str | None) -> list[tuple[int, int, str, str, bool, bool]]:
    """(start, end, words before, words after, known format?, assigned?) of each candidate in one whole text, by code point."""
    out = []
    if not text or not HINT.search(text):
        return out
    for m in CANDIDATE.finditer(text):
        group = "val" if m["val"] else m.lastgroup if m.lastgroup in ("pem", "fmt", "raw") else "raw"
        start, end = m.span(group)
        value = text[start:end].rstrip(".,;:!?)")
        end = start + len(value)
        if len(value) < 8:
            continue
        before = (m["key"] or "") + " " + " ".join(text[max(0, start - 60) : start].split()[-3:])
        out.append((start, end, before, " ".join(text[end : end + 60].split()[:2]), group in ("pem", "fmt") or bool(FORMATS.fullmatch(value)), group == "val"))
    return out


def candidates(text: str | None, steps: np.ndarray) -> list[tuple[int, int, list[float]]]:
    """(start, end, features) of each candidate."""
    return [(s, e, features(text[s:e], before, after, known, assigned, steps)) for s, e, before, after, known, assigned in spans(text)]


def labelled_findings(n: int = 4000, seed: int = 11) -> list[tuple[str, int]]:
    """Deterministic labelled findings: lines that hold one candidate each, label 1 for a secret and 0 for a false alarm."""
    r = random.Random(seed)
    some = lambda alphabet, k: "".join(r.choices(alphabet, k=k))
    alnum, hexa, word = string.ascii_letters + string.digits, "0123456789abcdef", lambda: r.choice(DICTIONARY)
    yes = [
        lambda: f"key AKIA{some(string.ascii_uppercase + string.digits, 16)}", lambda: f"{word()} AKIA{some(string.ascii_uppercase + '234567', 16)} {word()}", lambda: f"ghp_{some(alnum, 36)}", lambda: f"use sk-{some(alnum, r.randint(24, 48))} here",
        lambda: f"password={some(hexa, r.randint(12, 24))}", lambda: f'token = "{some(hexa, 40)}"', lambda: f"api_key: {some(alnum, r.randint(20, 40))}", lambda: f"secret='{some(alnum + '+/', 40)}'",
        lambda: f"password: {some(alnum + '!@#%^&', r.randint(10, 18))}", lambda: f"{word()} token {some(alnum, r.randint(28, 44))}", lambda: f"AIza{some(alnum + '_-', 35)}", lambda: f"auth={some(hexa, 32)}",
        lambda: f"eyJ{some(alnum, 20)}.{some(alnum, 40)}.{some(alnum + '_-', 43)}",
    ]
    no = [
        lambda: f"sha256 {some(hexa, 64)}", lambda: f"commit {some(hexa, 40)}", lambda: f"md5: {some(hexa, 32)}", lambda: f"uuid {some(hexa, 8)}-{some(hexa, 4)}-{some(hexa, 4)}-{some(hexa, 4)}-{some(hexa, 12)}",
        lambda: f"see https://{word()}.{word()}.com/{word()}/{word()}{r.randint(1, 9999)}", lambda: f"/usr/{word()}/{word()}-{r.randint(1, 99)}.{r.randint(0, 9)}/{word()}", lambda: f"{word()}_{word()}_{word()}_{word()}{r.randint(1, 99)}",
        lambda: f"password={word()}_{word()}", lambda: f"token: {word()}.{word()}.{word()}", lambda: f"password=your_{word()}_here", lambda: f"api_key=xxxxxxxxxxxx{r.randint(1, 9)}", lambda: f"secret=example{some('0123456789', 4)}", lambda: f"key = {word()}{word()}()",
        lambda: f"page {r.randint(1000, 9999)}-{some('0123456789', 4)}-{some('0123456789', 4)}-{some('0123456789', 8)}", lambda: f"{word()}.{word()}.{word()}.v{r.randint(1, 9)}.{r.randint(0, 9)}", lambda: f"token={some('0', 16)}", lambda: f"{word()}{word()}{word()}{word()}{r.randint(1, 9)}",
    ]
    out = []
    for i in range(n):
        out.append((r.choice(yes)(), 1) if i % 2 else (r.choice(no)(), 0))
    return out


class Forest:
    """A random forest of binary trees over numeric features; trees are arrays (feature, cut, left, right, share of ones)."""

    def __init__(self, trees: int = 25, depth: int = 9, leaf: int = 4, seed: int = 5):
        self.n_trees, self.depth, self.leaf, self.seed = trees, depth, leaf, seed
        self.trees: list[np.ndarray] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        rng = np.random.default_rng(self.seed)
        self.trees = []
        for _ in range(self.n_trees):
            nodes: list[list[float]] = []
            rows = rng.integers(0, len(y), len(y))
            self._grow(x, y, rows, 0, nodes, rng)
            self.trees.append(np.array(nodes))
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, rows: np.ndarray, depth: int, nodes: list, rng: np.random.Generator) -> int:
        me, share = len(nodes), float(y[rows].mean())
        nodes.append([-1, 0, 0, 0, share])
        if depth >= self.depth or len(rows) < 2 * self.leaf or share in (0.0, 1.0):
            return me
        best = (share * (1 - share) * len(rows) - 1e-9, -1, 0.0)
        for f in rng.choice(x.shape[1], max(2, int(math.sqrt(x.shape[1]))), replace=False):
            values = x[rows, f]
            order = np.argsort(values, kind="stable")
            v, ones = values[order], np.cumsum(y[rows][order])
            at = np.flatnonzero(v[1:] > v[:-1]) + 1
            at = at[(at >= self.leaf) & (at <= len(rows) - self.leaf)]
            if len(at):
                left, n = ones[at - 1], len(rows)
                right = ones[-1] - left
                cost = left * (1 - left / at) + right * (1 - right / (n - at))
                k = int(np.argmin(cost))
                if cost[k] < best[0]:
                    best = (float(cost[k]), int(f), float((v[at[k]] + v[at[k] - 1]) / 2))
        if best[1] >= 0:
            go = x[rows, best[1]] <= best[2]
            nodes[me][:2] = best[1], best[2]
            nodes[me][2] = self._grow(x, y, rows[go], depth + 1, nodes, rng)
            nodes[me][3] = self._grow(x, y, rows[~go], depth + 1, nodes, rng)
        return me

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for tree in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth + 1):
                f = tree[at, 0].astype(np.int64)
                step = np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= tree[at, 1], tree[at, 2], tree[at, 3]).astype(np.int64)
                at = np.where(f < 0, at, step)
            total += tree[at, 4]
        return total / max(len(self.trees), 1)


@dataclass(frozen=True)
class Model:
    steps: np.ndarray  # of transitions
    forest: Forest


def train(findings: list[tuple[str, int]] | None = None) -> Model:
    """A model from labelled lines, of which the first MAX_FINDINGS are read; a line's own candidates take its label.

    Transitions are learned from every other line and the forest from the rest, so that it sees them as on unknown lines.
    """
    lines = (labelled_findings() if findings is None else findings)[:MAX_FINDINGS]
    half, rest = [x for k, x in enumerate(lines) if k % 4 < 2], [x for k, x in enumerate(lines) if k % 4 >= 2]
    known = [(line[s:e], label) for line, label in half for s, e, *_ in spans(line)]
    steps = transitions([v for v, _ in known], [label for _, label in known])
    x, y = [], []
    for line, label in rest:
        for _, _, f in candidates(line, steps):
            x.append(f)
            y.append(label)
    return Model(steps, Forest().fit(np.array(x), np.array(y, dtype=np.float64)))


def find(texts: list[str | None], model: Model, cut: float) -> tuple[list[list[tuple[int, int, float]]], list[int]]:
    """For each text its (start, end, score) at or over the cut, and its number of candidates."""
    got = [candidates(t, model.steps) for t in texts]
    flat = [f for one in got for _, _, f in one]
    scores = iter(model.forest.score(np.array(flat)) if flat else ())
    scored = [[(s, e, float(next(scores))) for s, e, _ in one] for one in got]
    return [[x for x in one if x[2] >= cut] for one in scored], [len(one) for one in got]


def secret_scan(docs: DataFrame, model: Model | None = None, cut: float = 0.5, key: str = "doc_id") -> DataFrame:
    """key, n_candidates, n_secrets, spans ("start-end" by code point, comma-joined) and the highest score, a row each.

    Null and empty texts have no candidates (score 0.0, spans ''); null keys stay; repeated rows are scanned one by one; other
    columns are ignored, whatever their names; an empty table gives none.
    """
    model, name = model or train(), ("secrets", uuid.uuid4().hex)
    narrow = docs.select(key, "text")
    schema = narrow.select(key).schema.add("n_candidates", "long").add("n_secrets", "long").add("spans", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(name, lambda: model)
        for batch in (part for whole in batches for part in slices(whole, 1, n_bytes=SLICE)):
            found, n = find(batch.column(1).to_pylist(), known, cut)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array([len(x) for x in found], pa.int64()), pa.array([",".join(f"{s}-{e}" for s, e, _ in x) for x in found], pa.string()), pa.array([max((p for _, _, p in x), default=0.0) for x in found], pa.float64())], names=schema.names)

    return narrow.mapInArrow(run, schema)


def redact(docs: DataFrame, model: Model | None = None, cut: float = 0.5, mask: str = "[SECRET]") -> DataFrame:
    """docs with each secret of `text` replaced by mask, and n_chars (if there) counted anew for changed texts; no row goes.

    Null and empty texts and all other columns, whatever their names, stay as they are.
    """
    model, name = model or train(), ("secrets", uuid.uuid4().hex)
    names = docs.columns
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(name, lambda: model)
        for batch in (part for whole in batches for part in slices(whole, at, n_bytes=SLICE)):
            texts = batch.column(at).to_pylist()
            found, _ = find(texts, known, cut)
            columns, sizes = list(batch.columns), batch.column(chars).to_pylist() if chars is not None else None
            for i, spans in enumerate(found):
                if spans:
                    text = texts[i]
                    for s, e, _ in reversed(spans):
                        text = text[:s] + mask + text[e:]
                    texts[i] = text
                    if sizes is not None:
                        sizes[i] = len(text)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if sizes is not None:
                columns[chars] = pa.array(sizes, batch.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
