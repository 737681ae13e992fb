"""Operator 10: SentencePiece encoding and decoding, giant documents by a max-plus parallel scan.

A text of up to ``CHUNK`` characters is encoded in one task. A longer one is cut into chunks that are spread
over tasks: each yields a transfer matrix from the pieces that can lie over its first border to those
over its last, the matrices of a document are combined by max-plus products, and with the pieces at its
borders known each chunk is traced back on its own. Ids equal those of the model's own encoder, see
``pieces``; the model file's path is a parameter.

Null and empty texts have no ids; decoding no ids, or null, gives the empty text. A text that holds the
blank mark itself comes back with blanks in its place. Repeated rows are encoded row by row; a giant text
that repeats under one id is scanned once. An empty table gives an empty table; other columns are kept,
whatever their names, but those named as the added ones.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import packed, slices, texts, unpacked, whole_groups
from ledgerpulse.llm.pieces import NEVER, escaped, load, load_texts, product
from ledgerpulse.storage import materialize

CHUNK = 1 << 15
DOC = ["doc_id", "h"]
ADDED = ["n_tokens", "ids"]


def _kinds(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)


def _lists(found: list[np.ndarray]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(f) for f in found])].astype(np.int32)
    flat = np.concatenate(found) if found else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def whole_texts(docs: DataFrame, path: str) -> DataFrame:
    """Rows whose text is encoded in one go, with ``ids`` in place of the text."""
    keep = [c for c in docs.columns if c != "text"]

    def apply(batches):
        model = load(path)
        for batch in slices(batches):
            ids = _lists([model.encode_text(t) for t in texts(batch)])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids], [*keep, "ids"])

    return docs.mapInArrow(apply, f"{_kinds(docs, keep)}, ids array<int>")


def chunks(docs: DataFrame, path: str, size: int) -> DataFrame:
    """(doc_id, h, no, final, head, tail, s): chunks of escaped texts between two cuts, with what lies around."""
    def apply(batches):
        around = load(path).longest
        for batch in slices(batches, 8):
            for doc_id, h, text in zip(batch.column("doc_id"), batch.column("h"), texts(batch), strict=True):
                s = escaped(text)
                cuts = [*range(0, max(1, len(s) - size // 2), size), len(s)]   # the last chunk has half to one and a half
                low = [max(0, c - around) for c in cuts[:-1]]
                n = len(low)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id.as_py()] * n, batch.schema.field("doc_id").type), pa.array([h.as_py()] * n, pa.int64()),
                     pa.array(range(n), pa.int32()), pa.array([k == n - 1 for k in range(n)]),
                     pa.array([c - a for c, a in zip(cuts, low, strict=False)], pa.int32()),
                     pa.array([c - a for c, a in zip(cuts[1:], low, strict=True)], pa.int32()),
                     pa.array([s[a:c + around] for a, c in zip(low, cuts[1:], strict=True)])],
                    [*DOC, "no", "final", "head", "tail", "s"])

    return docs.select(*DOC, "text").mapInArrow(
        apply, f"{_kinds(docs, DOC)}, no int, final boolean, head int, tail int, s string")


def matrices(parts: DataFrame, path: str) -> DataFrame:
    """(doc_id, h, no, rows, matrix): transfer matrix of every chunk, as bits of its zeros."""
    def apply(batches):
        model = load(path)
        for batch in slices(batches, 16):
            found = [model.transfer(r["s"], r["head"], r["tail"], r["no"] == 0, r["final"])
                     for r in batch.select(["s", "head", "tail", "no", "final"]).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in [*DOC, "no"]), pa.array([len(m) for m in found], pa.int32()),
                 pa.array([(m == 0).astype(np.uint8).tobytes() for m in found], pa.binary())], [*DOC, "no", "rows", "matrix"])

    return parts.mapInArrow(apply, f"{_kinds(parts, DOC)}, no int, rows int, matrix binary")


def chosen_states(found: list[np.ndarray]) -> list[int]:
    """For each chunk the number of its first state on the best path through all matrices."""
    ahead = [np.zeros((1, 1))]
    for m in found:
        ahead.append(product(ahead[-1], m))
    state, out = 0, []
    for k in range(len(found) - 1, -1, -1):
        state = int((ahead[k][0] + found[k][:, state]).argmax())
        out.append(state)
    return out[::-1]


def borders(found: DataFrame) -> DataFrame:
    """(doc_id, h, no, enter, leave): each chunk's states on the best path; holds one document's matrices."""
    def apply(batches):
        for group in whole_groups(batches, DOC):
            rows = group.to_pylist()
            cut = [k for k, r in enumerate(rows) if r["no"] == 0] + [len(rows)]
            enter, leave = [], []
            for a, b in zip(cut, cut[1:], strict=False):
                path = chosen_states([np.where(np.frombuffer(r["matrix"], np.uint8).reshape(r["rows"], -1), 0.0, NEVER)
                                      for r in rows[a:b]])
                enter += path
                leave += [*path[1:], 0]
            whole = group.combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [*(whole.column(c).combine_chunks() for c in [*DOC, "no"]), pa.array(enter, pa.int32()),
                 pa.array(leave, pa.int32())], [*DOC, "no", "enter", "leave"])

    return found.repartition(*DOC).sortWithinPartitions(*DOC, "no").mapInArrow(
        apply, f"{_kinds(found, DOC)}, no int, enter int, leave int")


def traced(parts: DataFrame, path: str) -> DataFrame:
    """(doc_id, h, no, ids): ids of each chunk between its known border states."""
    def apply(batches):
        model = load(path)
        for batch in slices(batches, 16):
            out = []
            for r in batch.to_pylist():
                s, start, stop, before = r["s"], r["head"], r["tail"], -1
                if r["no"]:
                    before, _, end = model.states(s, start)[r["enter"]]
                    start += end
                if not r["final"]:
                    stop += model.states(s, stop)[r["leave"]][2]
                out.append(model.chunk_ids(s, start, before, stop))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in [*DOC, "no"]), _lists(out)], [*DOC, "no", "ids"])

    return parts.mapInArrow(apply, f"{_kinds(parts, DOC)}, no int, ids array<int>")


def _equal(a: DataFrame, b: DataFrame, names: list[str], prefix: str):
    same = F.lit(True)
    for c in names:
        same = same & a[c].eqNullSafe(b[f"{prefix}{c}"])
    return same


def giant_texts(docs: DataFrame, path: str, size: int) -> DataFrame:
    """(g_doc_id, g_h, ids) of long texts, by chunks."""
    by = [*DOC, "no"]
    parts = materialize(chunks(docs, path, size).repartition(*by).dropDuplicates(by), "chunks")
    states = borders(matrices(parts, path)).withColumnsRenamed({c: f"b_{c}" for c in by})
    joined = parts.join(states, _equal(parts, states, by, "b_")).select(*parts.columns, "enter", "leave")
    rows = F.array_sort(F.collect_list(F.struct("no", "ids")))
    return (traced(joined, path).groupBy(*DOC).agg(F.flatten(F.transform(rows, lambda r: r["ids"])).alias("ids"))
            .withColumnsRenamed({c: f"g_{c}" for c in DOC}))


def encode(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_tokens and ids in place of the text."""
    keep = [c for c in docs.columns if c != "text" and c not in ADDED]
    rows = docs.select(packed(keep), "doc_id", "text")
    size = F.coalesce(F.length("text"), F.lit(0))
    short = whole_texts(rows.where(size <= chunk).select("kept", "text"), path)
    long = rows.where(size > chunk).withColumn("h", F.xxhash64("text"))
    found = giant_texts(long.select(*DOC, "text"), path, chunk)
    kept = long.select("kept", *DOC)
    giant = kept.join(found, _equal(kept, found, DOC, "g_")).select("kept", "ids")
    return short.unionByName(giant).select(*unpacked(keep), F.size("ids").alias("n_tokens"), "ids")


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in ``out``."""
    keep = [c for c in encoded.columns if c != out]

    def apply(batches):
        model = load_texts(path)
        for batch in slices(batches):
            back = model.decode(batch.column(ids))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(back, pa.string())], [*keep, out])

    return encoded.select(*keep).mapInArrow(apply, f"{_kinds(encoded, keep)}, {out} string")
