"""Nested JSON records to flat linked tables by vectorised structural indexing."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of payload indexed at a time; a larger single payload is indexed alone.
CHUNK_BYTES = 2_000_000
OPEN, CLOSE = np.zeros(256, bool), np.zeros(256, bool)
OPEN[[ord("{"), ord("[")]] = True
CLOSE[[ord("}"), ord("]")]] = True
MARKS = OPEN | CLOSE
MARKS[[ord(","), ord(":")]] = True
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 13]] = True

#: Relations in which records come out, and the fields of each besides its place; a field's name in JSON where it is another.
RELATIONS = {
    "unit": [], "unreadable": [], "table": ["title", "label_header", "continued_from_previous", "section_id"], "column": ["column_group", "leaf"],
    "row": ["row_id", "row_type", "level", "parent", "label"], "value": ["value", "cell_state"],
}
MEMBER = {"column_group": "group"}
PLACE = ["rel string", "unit_id string", "table_no int", "row_no int", "col_no int"]


def schema_of(relations: Iterable[str]) -> str:
    return ", ".join([*PLACE, *(f"{field} string" for rel, fields in RELATIONS.items() if rel in relations for field in fields)])


SCHEMA = schema_of(RELATIONS)
#: Member names that are looked for, by the number they get.
NAMES = {name: i for i, name in enumerate(["extraction", "tables", "columns", "rows", "values", *(MEMBER.get(f, f) for fields in RELATIONS.values() for f in fields)])}


def bitmaps(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Structural positions outside strings, whether each document's quotes pair up, and the string bitmap."""
    n = len(buf)
    slash = np.flatnonzero(buf == 92)
    quote = buf == 34
    if len(slash):
        run = np.concatenate(([0], np.flatnonzero(np.diff(slash) != 1) + 1))
        nth = np.arange(len(slash)) - np.repeat(run, np.diff(np.append(run, len(slash))))
        escaped = slash[nth % 2 == 0] + 1
        quote[escaped[escaped < n]] = False
    count = np.cumsum(quote, dtype=np.int32)
    before = np.where(starts > 0, count[np.maximum(starts - 1, 0)], 0)
    ends = np.append(starts[1:], n)
    even = (np.where(ends > starts, count[ends - 1], before) - before) % 2 == 0
    inside = ((count - np.repeat(before, ends - starts)) % 2).astype(bool)
    return np.flatnonzero(MARKS[buf] & ~inside), even, inside | quote


class Index:
    """Spans of all values of a chunk of documents: one slot for each array item and each member of an object."""

    def __init__(self, docs: list[bytes]):
        docs = [d or b" " for d in docs]
        self.data = b"".join(docs)
        buf = np.frombuffer(self.data, np.uint8)
        lengths = np.array([len(d) for d in docs], np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
        self.pos, self.ok, _ = bitmaps(buf, starts)
        pos, kind = self.pos, buf[self.pos]
        m = len(pos)
        doc = np.searchsorted(starts, pos, "right") - 1 if m else np.zeros(0, np.int64)
        self.doc = doc
        opens, closes = OPEN[kind], CLOSE[kind]
        # nesting depth by prefix sums, started anew with every document
        step = opens.astype(np.int64) - closes
        depth = np.cumsum(step)
        first = np.searchsorted(doc, np.arange(len(docs)))
        last = np.searchsorted(doc, np.arange(len(docs)), "right")
        base = np.where((first > 0) & (first <= m), depth[np.maximum(np.minimum(first, m) - 1, 0)] if m else 0, 0)
        depth = depth - base[doc] if m else depth
        level = depth + closes  # the level of the container a mark belongs to
        some = last > first
        bad = np.ones(len(docs), bool)
        bad[some] = depth[last[some] - 1] != 0
        np.logical_or.at(bad, doc[level < 1], True)
        # within a document and level, marks between an opener and its closer belong to that opener
        order = np.lexsort((np.arange(m), level, doc))
        head = opens[order]
        run = np.maximum.accumulate(np.where(head, np.arange(m), -1)) if m else order
        home = np.full(m, -1)
        home[order] = np.where(run >= 0, order[np.maximum(run, 0)], -1)
        self.home = home
        shut = np.flatnonzero(closes)
        fits = (home[shut] >= 0) & (kind[np.maximum(home[shut], 0)] == kind[shut] - 2)
        np.logical_or.at(bad, doc[shut[~fits]], True)
        # the text from a mark to the next one, without blanks at its ends
        ends = starts + lengths
        nxt = np.append(pos[1:], len(buf)) if m else pos
        stop = np.minimum(nxt, ends[doc]) if m else nxt
        solid = np.flatnonzero(~BLANK[buf])
        a, b = np.searchsorted(solid, pos + 1), np.searchsorted(solid, stop)
        full = b > a
        lo = np.where(full, solid[np.minimum(a, max(len(solid) - 1, 0))] if len(solid) else 0, 0)
        hi = np.where(full, solid[np.maximum(b - 1, 0)] + 1 if len(solid) else 0, 0)
        next_kind = np.append(kind[1:], 0)
        next_kind[last[some] - 1] = 0
        in_object = np.where(home >= 0, kind[np.maximum(home, 0)] == 123, False)
        colon, comma = kind == 58, kind == 44
        key_start = (comma & in_object) | ((kind == 123) & ~((next_kind == 125) & ~full))
        item_start = (comma & ~in_object) | ((kind == 91) & ~((next_kind == 93) & ~full))
        value_start = item_start | colon
        nested = value_start & OPEN[next_kind]
        wrong = (colon & ~in_object) | (closes & (full | OPEN[next_kind] | (next_kind == 58))) | (key_start & ((next_kind != 58) | ~full)) | (nested & full) | (value_start & ~nested & (~full | (next_kind == 58)))
        wrong |= colon & ~np.concatenate(([False], key_start[:-1])) if m else colon
        np.logical_or.at(bad, doc[wrong], True)
        if m:  # nothing but blanks before the first mark and after the last
            for d in np.flatnonzero(some):
                if self.data[starts[d] : pos[first[d]]].strip():
                    bad[d] = True
        self.ok &= ~bad
        slot = np.flatnonzero(value_start)
        self.slot, self.container = slot, home[slot]
        self.child = np.where(nested[slot], slot + 1, -1)
        self.lo, self.hi, self.kind = lo[slot], hi[slot], kind
        self.key_at = np.where(colon[slot], slot - 1, -1)
        self.key_lo, self.key_hi = lo, hi
        # ordinal of an item in its array
        by = np.lexsort((slot, self.container))
        c = self.container[by]
        begin = np.concatenate(([0], np.flatnonzero(np.diff(c)) + 1)) if len(c) else np.zeros(0, np.int64)
        nth = np.arange(len(c)) - np.repeat(begin, np.diff(np.append(begin, len(c))))
        self.ordinal = np.empty(len(slot), np.int64)
        self.ordinal[by] = nth
        self.first = np.where(some, first, -1)
        self._check_scalars()

    def _check_scalars(self) -> None:
        """Keys and scalars as texts, each different one read once; those that no JSON text may hold make their document unreadable."""
        plain = np.flatnonzero(self.child < 0)
        texts, strings, good = _scalars(self._spans(self.lo[plain], self.hi[plain]))
        named = np.flatnonzero(self.key_at >= 0)
        at = self.key_at[named]
        keys, are_strings, good_keys = _scalars(self._spans(self.key_lo[at], self.key_hi[at]), lambda text: NAMES.get(text, -1), int)
        self.ok[self.doc[self.slot[plain[~good]]]] = False
        self.ok[self.doc[self.slot[named[~(good_keys & are_strings)]]]] = False
        text, key, string = np.full(len(self.slot), None, object), np.full(len(self.slot), -1), np.zeros(len(self.slot), bool)
        text[plain], string[plain], key[named] = texts, strings, keys
        self.slots = pd.DataFrame({"doc": self.doc[self.slot], "container": self.container, "child": self.child, "ordinal": self.ordinal, "key": key, "text": text, "string": string})

    def _spans(self, lo: np.ndarray, hi: np.ndarray) -> pa.BinaryArray:
        """The bytes of the spans, gathered at once."""
        size = np.maximum(hi - lo, 0)
        offsets = np.concatenate(([0], np.cumsum(size)))
        places = np.arange(offsets[-1]) - np.repeat(offsets[:-1], size) + np.repeat(lo, size)
        data = np.frombuffer(self.data, np.uint8)[places]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lo), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def _scalars(spans: pa.BinaryArray, use: Callable = lambda text: text, kind: type = object) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``use`` makes of each scalar's text (null for null), whether it is a string, and whether it is JSON at all; every different one is read once."""
    coded = pc.dictionary_encode(spans)
    read = [_scalar(raw) for raw in coded.dictionary.to_pylist()]
    codes = coded.indices.to_numpy(zero_copy_only=False)
    pick = lambda values, kind: np.array([*values, None], object)[:-1].astype(kind)[codes]
    return pick((use(r[0]) for r in read), kind), pick((r[1] for r in read), bool), pick((r[2] for r in read), bool)


def _string(raw: bytes) -> str:
    if len(raw) < 2 or raw[0] != 34 or raw[-1] != 34:
        raise ValueError("no string")
    return json.loads(raw) if b"\\" in raw or b'"' in raw[1:-1] or min(raw) < 32 else raw[1:-1].decode()


def _scalar(raw: bytes) -> tuple[str | None, bool, bool]:
    """(text, is a string, is JSON) of a scalar, numbers and truth values as they are written."""
    try:
        if raw[:1] == b'"':
            return _string(raw), True, True
        if raw == b"null":
            return None, False, True
        if raw not in (b"true", b"false"):
            json.loads(raw)
        return raw.decode(), False, True
    except ValueError:
        return None, False, False


def _members(slots: pd.DataFrame, of: pd.DataFrame, at: str, ordinal: str) -> pd.DataFrame:
    """Members of the array held by each slot of ``of``; an object in place of an array is its only member."""
    arrays = slots.merge(of[[at, "opener", "is_object"]].loc[~of["is_object"]], left_on="container", right_on="opener")
    one = of.loc[of["is_object"]]
    single = pd.DataFrame({at: one[at], "child": one["opener"], "ordinal": 0, "text": None})
    out = pd.concat([arrays[[at, "child", "ordinal", "text"]], single], ignore_index=True)
    return out.rename(columns={"ordinal": ordinal})


def _holding(slots: pd.DataFrame, kind: np.ndarray, parents: pd.DataFrame, at: str, key: str) -> pd.DataFrame:
    """For each parent object the container that its member ``key`` holds."""
    hit = slots.loc[(slots["key"] == NAMES[key]) & (slots["child"] >= 0), ["container", "child"]].drop_duplicates("container", keep="last")
    out = parents[[at, "child"]].rename(columns={"child": "parent_opener"}).merge(hit, left_on="parent_opener", right_on="container")
    opener = out["child"].to_numpy(np.int64)
    return pd.DataFrame({at: out[at], "opener": opener, "is_object": kind[opener] == 123 if len(opener) else np.zeros(0, bool)})


def _fields(slots: pd.DataFrame, rows: pd.DataFrame, relation: str) -> pd.DataFrame:
    """Scalar members of each row's object as the relation's columns; of repeated names the last counts."""
    for field in RELATIONS[relation]:
        part = slots.loc[(slots["key"] == NAMES[MEMBER.get(field, field)]) & (slots["child"] < 0), ["container", "text"]].drop_duplicates("container", keep="last")
        rows = rows.assign(**{field: rows["child"].map(part.set_index("container")["text"])})
    return rows


def flatten_chunk(units: list[str], payloads: list[bytes], relations: Iterable[str] = tuple(RELATIONS)) -> pd.DataFrame:
    """The linked rows of a chunk of payloads, of the relations asked for."""
    ix = Index(payloads)
    slots, kind = ix.slots, ix.kind
    ids = np.array(units, object)
    good = np.flatnonzero(ix.ok & (ix.first >= 0))
    frames = {"unit": pd.DataFrame({"unit": good}), "unreadable": pd.DataFrame({"unit": np.flatnonzero(~ix.ok | (ix.first < 0))})}
    slots = slots.loc[ix.ok[slots["doc"].to_numpy()]] if len(slots) else slots
    roots = pd.DataFrame({"unit": good, "child": ix.first[good]})
    inner = _holding(slots, kind, roots, "unit", "extraction").rename(columns={"opener": "child"})
    roots = pd.concat([roots, inner[["unit", "child"]]], ignore_index=True)
    tables = _members(slots, _holding(slots, kind, roots, "unit", "tables"), "unit", "table_no")
    tables["table"] = np.arange(len(tables))
    place = tables.set_index("table")[["unit", "table_no"]]
    if "table" in relations:
        frames["table"] = _fields(slots, tables, "table")
    if "column" in relations:
        frames["column"] = _fields(slots, _members(slots, _holding(slots, kind, tables, "table", "columns"), "table", "col_no").join(place, on="table"), "column")
    rows = _members(slots, _holding(slots, kind, tables, "table", "rows"), "table", "row_no").join(place, on="table")
    rows["row"] = np.arange(len(rows))
    if "row" in relations:
        frames["row"] = _fields(slots, rows, "row")
    if "value" in relations:
        values = _members(slots, _holding(slots, kind, rows, "row", "values"), "row", "col_no").join(rows.set_index("row")[["unit", "table_no", "row_no"]], on="row")
        values = _fields(slots, values, "value")
        frames["value"] = values.assign(value=values["value"].where(values["child"] >= 0, values["text"]))
    out = pd.concat([frames[rel].drop(columns="text", errors="ignore").assign(rel=rel) for rel in RELATIONS if rel in relations], ignore_index=True)
    out["unit_id"] = ids[out["unit"].to_numpy(np.int64)]
    return out.reindex(columns=[part.split()[0] for part in schema_of(relations).split(", ")])


def _unwrap(payload: str | None) -> bytes:
    """The payload's bytes without a byte order mark; a payload that is a JSON string holding JSON gives its content."""
    text = (payload or "").lstrip("\ufeff").strip()
    for _ in range(2):
        if not text.startswith('"'):
            break
        try:
            text = str(json.loads(text)).lstrip("\ufeff").strip()
        except ValueError:
            return b'"'
    return text.encode("utf-8", "surrogatepass")


def _batches(frames: Iterator[pd.DataFrame], relations: Iterable[str] = tuple(RELATIONS)) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        units, docs, size = [], [], 0
        for unit, payload in zip(pdf["unit_id"], pdf["payload"]):
            doc = _unwrap(payload)
            if docs and size + len(doc) > CHUNK_BYTES:
                yield _typed(flatten_chunk(units, docs, relations))
                units, docs, size = [], [], 0
            units.append(unit)
            docs.append(doc)
            size += len(doc)
        if docs:
            yield _typed(flatten_chunk(units, docs, relations))


def _typed(out: pd.DataFrame) -> pd.DataFrame:
    for name in out.columns:
        if name in ("table_no", "row_no", "col_no"):
            out[name] = out[name].astype("Int32")
        else:
            text = out[name].astype(object)
            out[name] = text.where(text.notna(), None)
    return out


def flatten(payloads: DataFrame, relations: Iterable[str] = tuple(RELATIONS)) -> DataFrame:
    """Rows of SCHEMA from (unit_id, payload JSON text): all relations asked for in one frame, told apart by ``rel``.

    Rows keep their place (table_no, row_no, col_no from 0, null members counted) as their link to the row above
    them: unit < table < column, and table < row < value. A value may be an object with value and cell_state, a
    plain string or a number; null values give rows without a value. The tables may sit in a member ``extraction``;
    an object in place of an array is its only member; a byte order mark and a JSON text inside a JSON string are
    accepted. Payloads that are no JSON object (null, empty, cut off, malformed) give one row ``unreadable``.
    Of repeated member names the last counts. An empty table gives an empty result; other columns are ignored.
    """
    return payloads.select("unit_id", "payload").mapInPandas(partial(_batches, relations=tuple(relations)), schema_of(relations))


def unit_payloads(parsed: DataFrame, parsed_raw: DataFrame) -> DataFrame:
    """(unit_id, payload), each unit once: typed records as JSON text, raw payloads as delivered, the latest of repeats."""
    typed = parsed.select("unit_id", F.to_json(F.struct("tables")).alias("payload"), F.col("extracted_at").alias("at"))
    raw = parsed_raw.select("unit_id", "payload", F.col("received_at").alias("at"))
    both = typed.unionByName(raw)
    return both.groupBy("unit_id").agg(F.max(F.struct(F.col("at").isNotNull(), "at", "payload")).alias("last")).select("unit_id", "last.payload")


def stated_values(flat: DataFrame) -> DataFrame:
    """Positions of the values whose text is neither null nor empty."""
    return flat.where("rel = 'value' and value <> ''").select("unit_id", "table_no", "row_no", "col_no")
