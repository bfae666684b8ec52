"""Personal data: base patterns, and a skip-chain conditional random field on top.

The base patterns decide for what matches them.  The field's nodes are all
number-like and address-like strings of a document, its labels the kinds and
"none".  Strings next to each other share a potential, and so do distant ones
that are the same or similar (same last digits, same first digits, same local
part); loopy message passing carries labels along both.  So a phone number that
once stands with its country prefix is also found where it stands without.
Potentials are learned from what the base patterns find in a sample.

All strings that share a key meet in one hub, so that any two are two steps apart
and a document's graph grows with its length only.  What the base patterns have
decided is observed: where it stands among the strings of a key, the hub is known,
and each other string is linked with it directly.  Links are learned from each
string and the next that shares a key.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorestream.llm.frames import keyed_text, texts_of

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = NONE + 1

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"[+(]{0,2}[0-9](?:[ ().-]{0,2}[0-9])*")
DIGIT_RUN = re.compile(r"[0-9]+")
LOCAL_PIECE = 256

LEAST_DIGITS = 7
NEAR_CHARS = 40
CLAMP = 30.0
#: Log odds of "none" where nothing is known of a string's form.
PRIOR = 1.0
BOUND = 4.0
#: Messages of a document stop when none changes by more; loops that never settle stop at the bound.
TOLERANCE = 1e-4
MOST_ROUNDS = 2000
CERTAIN = 0.8
NODES_AT_ONCE = 50_000

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(v * 2 - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def local_start(text: str, at: int, floor: int) -> int:
    """Where the run of local-part characters that ends at ``at`` begins, not before ``floor``."""
    start = at
    while start > floor:
        low = max(floor, start - LOCAL_PIECE)
        found = LOCAL_END.search(text[low:start])
        if found is None:
            break
        start = low + found.start()
        if start > low:
            break
    return start


def addresses(text: str, domain: re.Pattern) -> list[tuple[int, int]]:
    """Leftmost non-overlapping local parts, @ and domains.

    A run before an @ is tried from its first character only: from any other the
    match would end the same, so that long runs cost no more than their length.
    """
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = local_start(text, at, last)
        if start < at and (match := domain.match(text, at + 1)):
            last = match.end()
            found.append((start, last))
        at = text.find("@", max(at + 1, last))
    return found


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of what the base patterns find, by start and kind."""
    found = [(start, 0, end) for start, end in addresses(text, DOMAIN)]
    for match in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
            found.append((match.start(), 1, match.end()))
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = match[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((match.start(), 2, match.end()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, match[0])) <= 15:
                found.append((match.start(), 3, match.end()))
    return sorted(found)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


@dataclass
class Node:
    start: int
    end: int
    label: int
    allowed: tuple[int, ...]
    features: tuple[str, ...]
    keys: tuple[str, ...]


def nodes_of(text: str, base: list[Span]) -> list[Node]:
    """Strings that could be personal data, in order; ``label`` is the base pattern's, or none."""
    spots = [(s, e, True) for s, e in addresses(text, LOOSE_DOMAIN)]
    spots += [
        (m.start(), m.end(), False) for m in NUMBER.finditer(text) if m.end() - m.start() >= LEAST_DIGITS
    ]
    spots.sort()
    out, held = [], 0
    for start, end, address in spots:
        raw = text[start:end]
        digits = "".join(DIGIT_RUN.findall(raw))
        if not address and len(digits) < LEAST_DIGITS:
            continue
        while held < len(base) and base[held][2] <= start:
            held += 1
        label = NONE
        for k in range(held, len(base)):
            if base[k][0] >= end:
                break
            if base[k][2] > start and (label == NONE or not address):
                label = base[k][1]
        if address:
            local, _, domain = raw.partition("@")
            features = ("address", f"dots={min(domain.count('.'), 3)}")
            keys = (f"local {local.lower()}",)
            allowed = (0, NONE)
        else:
            groups = [len(g) for g in DIGIT_RUN.findall(raw)]
            shape = ".".join(map(str, groups[:6])) if len(groups) > 1 else "one"
            signs = "".join(sorted(set(raw) - set("0123456789")))
            checked = 12 <= len(digits) <= 19 and luhn(digits)
            features = (f"digits={min(len(digits), 20)}", f"groups={shape}", f"signs={signs}", f"check={checked}")
            keys = (f"tail {digits[-LEAST_DIGITS:]}", f"head {len(digits)} {digits[:-4]}")
            fits = (False, len(groups) == 4 and signs == ".", 12 <= len(digits) <= 19, len(digits) <= 15, True)
            allowed = tuple(np.flatnonzero(fits).tolist())
        out.append(Node(start, end, label, allowed, features, keys))
    return out


def links_of(nodes: list[Node]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(neighbouring pairs, skip pairs): each node with the next one, and with the next that shares a key."""
    near = [(i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1].start - nodes[i].end <= NEAR_CHARS]
    last: dict[str, int] = {}
    skip = []
    for i, node in enumerate(nodes):
        skip += sorted({(last[key], i) for key in node.keys if key in last})
        last.update(dict.fromkeys(node.keys, i))
    return near, skip


def graph_of(nodes: list[Node]) -> tuple[list, list, int, list, list]:
    """(near pairs, skip pairs, hubs, near evidence, skip evidence) of strings the base patterns left open.

    Hubs are numbered after the nodes.  Evidence is (node, observed label).
    """
    near, seen_near, skip, seen_skip, hubs = [], [], [], [], 0
    for a, b in links_of(nodes)[0]:
        one, other = nodes[a].label, nodes[b].label
        if one == other == NONE:
            near.append((a, b))
        elif other == NONE:
            seen_near.append((b, one))
        elif one == NONE:
            seen_near.append((a, other))
    members: dict[str, list[int]] = {}
    for i, node in enumerate(nodes):
        for key in node.keys:
            members.setdefault(key, []).append(i)
    for group in sorted({tuple(m) for m in members.values() if len(m) > 1}):
        labels = sorted({nodes[i].label for i in group} - {NONE})
        open_ones = [i for i in group if nodes[i].label == NONE]
        if labels:
            seen_skip += [(i, label) for i in open_ones for label in labels]
        elif len(group) == 2:
            skip.append(group)
        else:
            skip += [(i, len(nodes) + hubs) for i in group]
            hubs += 1
    return near, sorted(set(skip)), hubs, seen_near, seen_skip


def _along(belief: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """Messages over links: what a belief says of the label at the other end."""
    inward = belief[:, :, None] + potential
    top = inward.max(axis=1)
    fresh = top + np.log(np.exp(inward - top[:, None, :]).sum(axis=1))
    return fresh - fresh.max(axis=1, keepdims=True)


@dataclass
class Field:
    """Learned potentials: labels per feature, and pairs of labels along either sort of link."""

    weights: dict[str, np.ndarray]
    near: np.ndarray
    skip: np.ndarray

    def unary(self, node: Node) -> np.ndarray:
        if node.label != NONE:
            return np.where(np.arange(LABELS) == node.label, CLAMP, 0.0)
        total = np.where(np.arange(LABELS) == NONE, PRIOR, 0.0)
        for feature in node.features:
            if feature in self.weights:
                total += self.weights[feature]
        bounded = np.clip(total - total.max(), -BOUND, 0)
        return np.where(np.isin(np.arange(LABELS), node.allowed), bounded, -CLAMP)

    def marginals(
        self, unary: np.ndarray, near: np.ndarray, skip: np.ndarray, owner: np.ndarray | None = None
    ) -> np.ndarray:
        """Label probabilities of all nodes by loopy message passing, damped by half.

        ``owner`` numbers the document of each node; the messages of a document
        stop when they have settled, whatever other documents do.
        """
        owner = np.zeros(len(unary), np.int64) if owner is None else owner
        a, b = np.concatenate([near, skip]).T
        potential = np.concatenate(
            [np.broadcast_to(self.near, (len(near), LABELS, LABELS)), np.broadcast_to(self.skip, (len(skip), LABELS, LABELS))]
        )
        there, back = np.zeros((2, len(a), LABELS))
        settled = unary.copy()
        for turn in range(1, MOST_ROUNDS + 1):
            if not len(a):
                break
            belief = settled.copy()
            np.add.at(belief, b, there)
            np.add.at(belief, a, back)
            fresh_there = _along(belief[a] - back, potential)
            fresh_back = _along(belief[b] - there, potential.transpose(0, 2, 1))
            moved = np.maximum(np.abs(fresh_there - there).max(axis=1), np.abs(fresh_back - back).max(axis=1))
            there, back = (there + fresh_there) / 2, (back + fresh_back) / 2
            restless = np.zeros(owner.max() + 1, bool)
            restless[owner[a[moved > TOLERANCE]]] = True
            live = restless[owner[a]] & (turn < MOST_ROUNDS)
            if not live.all():
                np.add.at(settled, b[~live], there[~live])
                np.add.at(settled, a[~live], back[~live])
                a, b, potential, there, back = a[live], b[live], potential[live], there[live], back[live]
        belief = np.exp(settled - settled.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)

    def added(self, documents: list[list[Node]]) -> list[list[Span]]:
        """Spans that the field finds beyond the base patterns, per document.

        Documents whose strings are all decided by the base patterns need no inference.
        """
        out: list[list[Span]] = [[] for _ in documents]
        nodes: list[tuple[int, Node | None]] = []
        near, skip, seen_near, seen_skip = [], [], [], []
        for at, own in enumerate(documents):
            if all(node.label != NONE for node in own):
                continue
            first = len(nodes)
            own_near, own_skip, hubs, own_seen_near, own_seen_skip = graph_of(own)
            nodes += [(at, node) for node in own] + [(at, None)] * hubs
            near += [(a + first, b + first) for a, b in own_near]
            skip += [(a + first, b + first) for a, b in own_skip]
            seen_near += [(a + first, label) for a, label in own_seen_near]
            seen_skip += [(a + first, label) for a, label in own_seen_skip]
        if nodes:
            unary = np.array([np.zeros(LABELS) if node is None else self.unary(node) for _, node in nodes])
            near, skip, seen_near, seen_skip = (
                np.array(x, np.int64).reshape(-1, 2) for x in (near, skip, seen_near, seen_skip)
            )
            np.add.at(unary, seen_near[:, 0], self.near[seen_near[:, 1]])
            np.add.at(unary, seen_skip[:, 0], self.skip[seen_skip[:, 1]])
            chance = self.marginals(unary, near, skip, np.array([at for at, _ in nodes]))
            label = chance.argmax(axis=1)
            for k in np.flatnonzero((label != NONE) & (chance.max(axis=1) >= CERTAIN)):
                at, node = nodes[k]
                if node is not None and node.label == NONE:
                    out[at].append((node.start, int(label[k]), node.end))
        return out


EXAMPLES = "sort string, features string, a int, b int, n long"


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[tuple, int] = {}
        for text in texts_of(batch):
            nodes = nodes_of(text, base_spans(text))
            near, skip = links_of(nodes)
            rows = [("node", "\t".join(n.features), n.label, n.label) for n in nodes]
            rows += [("near", "", nodes[a].label, nodes[b].label) for a, b in near]
            rows += [("skip", "", nodes[a].label, nodes[b].label) for a, b in skip]
            for row in rows:
                counts[row] = counts.get(row, 0) + 1
        columns = list(zip(*counts)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.string()),
                pa.array(columns[1], pa.string()),
                pa.array(columns[2], pa.int32()),
                pa.array(columns[3], pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            [part.split()[0] for part in EXAMPLES.split(", ")],
        )


def _pair_potential(rows: list[tuple[int, int, int]]) -> np.ndarray:
    """Log of how much likelier two labels are linked than by chance, bounded; symmetric."""
    seen = np.full((LABELS, LABELS), 0.1)
    for a, b, n in rows:
        seen[a, b] += n
    seen = seen + seen.T
    share = seen.sum(axis=1)
    return np.clip(np.log(seen * seen.sum() / np.outer(share, share)), -2 * BOUND, 2 * BOUND)


def _unary_weights(rows: list[tuple[tuple[str, ...], int, int]]) -> dict[str, np.ndarray]:
    """Multinomial logistic regression on counted feature sets, by accelerated gradient steps."""
    names = sorted({f for features, _, _ in rows for f in features})
    place = {f: i for i, f in enumerate(names)}
    if not rows:
        return {}
    flat = np.array([place[f] for features, _, _ in rows for f in features], np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(features) for features, _, _ in rows])
    label = np.array([r[1] for r in rows])
    weight = np.array([r[2] for r in rows], float) / sum(r[2] for r in rows)
    theta, ahead = np.zeros((len(names), LABELS)), np.zeros((len(names), LABELS))
    for step in range(300):
        score = np.zeros((len(rows), LABELS))
        np.add.at(score, owner, ahead[flat])
        score = np.exp(score - score.max(axis=1, keepdims=True))
        gap = score / score.sum(axis=1, keepdims=True)
        gap[np.arange(len(rows)), label] -= 1
        gap *= weight[:, None]
        slope = np.zeros_like(theta)
        np.add.at(slope, flat, gap[owner])
        fresh = ahead - 0.4 * (slope + 1e-5 * ahead)
        ahead = fresh + step / (step + 3) * (fresh - theta)
        theta = fresh
    return dict(zip(names, theta))


def fit_field(
    docs: DataFrame,
    sample_documents: int = 20_000,
    feature_sets: int = 20_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Field:
    """Potentials from about ``sample_documents`` whole documents, chosen by a hash of their id.

    Strings are counted by feature set and label where they are read; the
    ``feature_sets`` most frequent counts reach the driver.
    """
    rows = keyed_text(docs, id_column, text_column)
    total = max(1, rows.count())
    grain = 1_000_000
    share = min(grain, grain * sample_documents // total + 1)
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < share)
    counted = chosen.select("text").mapInArrow(_examples, EXAMPLES).groupBy("sort", "features", "a", "b")
    counted = counted.agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "sort", "features", "a", "b").limit(feature_sets)
    found = counted.collect()
    pairs = {
        sort: _pair_potential([(r["a"], r["b"], r["n"]) for r in found if r["sort"] == sort]) for sort in ("near", "skip")
    }
    weights = _unary_weights(
        [(tuple(r["features"].split("\t")), r["a"], r["n"]) for r in found if r["sort"] == "node"]
    )
    return Field(weights, **pairs)


FOUND = "doc_id {}, n_email long, n_ip long, n_card long, n_phone long, n_added long, base_sha256 string, spans string"


def find_private(docs: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: base spans counted by kind, added ones, digest of the base spans, all spans.

    Spans are ``kind:start:end`` in code points, by start and kind, comma-joined;
    a document without any has an empty string.  A null text is empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part, bases, more in _searched(batch, own):
                everything = [sorted(b + a) for b, a in zip(bases, more)]
                columns = [pa.array([sum(s[1] == k for s in b) for b in bases], pa.int64()) for k in range(NONE)]
                digests = [hashlib.sha256(written(b).encode("ascii")).hexdigest() for b in bases]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *columns,
                        pa.array(map(len, more), pa.int64()),
                        pa.array(digests, pa.string()),
                        pa.array(map(written, everything), pa.string()),
                    ],
                    [x.split()[0] for x in FOUND.split(", ")],
                )

    rows = keyed_text(docs, id_column, text_column)
    return rows.mapInArrow(run, FOUND.format(rows.schema["doc_id"].dataType.simpleString()))


def _searched(
    batch: pa.RecordBatch, field: Field, text_column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, list, list]]:
    """Slices of a batch with base and added spans; a slice ends when its strings reach a bound."""
    start, held, bases, nodes = 0, 0, [], []
    for at, text in enumerate(texts_of(batch, text_column)):
        bases.append(base_spans(text))
        nodes.append(nodes_of(text, bases[-1]))
        held += len(nodes[-1])
        if held >= NODES_AT_ONCE or at + 1 == batch.num_rows:
            yield batch.slice(start, at + 1 - start), bases, field.added(nodes)
            start, held, bases, nodes = at + 1, 0, [], []


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, overlapping ones as one, replaced by its first kind in brackets."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field, text_column: str = "text") -> DataFrame:
    """The same rows and columns, with personal data in the text replaced; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part, bases, more in _searched(batch, own, text_column):
                texts = [
                    None if text is None else redacted(text, sorted(b + a))
                    for text, b, a in zip(part.column(place).to_pylist(), bases, more)
                ]
                columns = list(part.columns)
                columns[place] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return docs.mapInArrow(run, docs.schema)
