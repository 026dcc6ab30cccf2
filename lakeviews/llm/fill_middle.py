"""Fill-in-the-middle transformation of texts, as one pass of Arrow kernels.

A text's units are its lines with their breaks.  Two cuts between units give a
prefix, a middle and a suffix; the text is put out as it is (plain), or with
the marks ``<P>``, ``<S>`` and ``<M>`` in the order prefix, suffix, middle
(psm) or suffix, prefix, middle (spm).

A batch of texts is split into a list array of units, which is flattened; a
unit's text is its parent index and its ordinal is its place after the first
unit of that text.  Units are filtered by role (before the first cut, up to the
second, after it), each role's units are put back into one list a text, the
lists are joined into pieces, and the pieces into outputs.  Batches are taken
in slices of about ``SLICE`` bytes of whole texts.  There is no shuffle: cuts
and forms come from a digest of the id, so that reruns agree.

Defined results: null and empty texts are plain, with no unit; a text that
holds a mark is plain; a null id is drawn like the text "null"; repeated rows
and equal ids give the same cuts for equal numbers of units; texts of any length
are whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeviews.llm.common import slices, small_batches, table

SEED = 7
RATE, SPM = 100, 50  # percent of texts that are transformed; of these, put out as spm
MARKS = ("<P>", "<S>", "<M>")
SLICE = 4 << 20
OUT = pa.schema([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.large_string())])


def units(texts: pa.Array) -> pa.LargeListArray:
    """Lists of lines, each with its break; nothing for an empty text."""
    lines = pc.split_pattern(texts, "\n")
    n = pc.list_value_length(lines).to_numpy(zero_copy_only=False)
    flat, ends = pc.list_flatten(lines), np.cumsum(n)
    last = np.zeros(len(flat), bool)
    last[ends - 1] = True  # what follows the last break: a line without a break, or nothing
    whole = pc.if_else(pa.array(last), flat, pc.binary_join_element_wise(flat, pa.scalar("\n", flat.type), pa.scalar("", flat.type)))
    real = ~(last & pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False))
    return lists(whole, pc.list_parent_indices(lines).to_numpy(), real, len(texts))


def lists(flat: pa.Array, parent: np.ndarray, chosen: np.ndarray, size: int) -> pa.LargeListArray:
    """The chosen elements as one list for each of ``size`` parents."""
    counts = np.bincount(parent[chosen], minlength=size)
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)])), flat.filter(pa.array(chosen)))


def transformed(texts: pa.Array, draws: list[np.ndarray], rate: int = RATE, spm: int = SPM) -> pa.RecordBatch:
    """n, form, prefix_chars, middle_chars and output of texts; ``draws`` are four unsigned 32-bit numbers a text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    h1, h2, h3, h4 = draws
    of = units(texts)
    n = pc.list_value_length(of).to_numpy()
    one, two = h1 % (n + 1), h2 % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    flat, parent = pc.list_flatten(of), pc.list_parent_indices(of).to_numpy()
    ordinal = np.arange(len(flat)) - of.offsets.to_numpy()[parent]
    empty = pa.scalar("", pa.large_string())
    prefix, middle, suffix = (pc.binary_join(lists(flat, parent, role, len(texts)), empty) for role in
                              (ordinal < low[parent], (ordinal >= low[parent]) & (ordinal < high[parent]), ordinal >= high[parent]))
    plain = (n == 0) | (h3 % 100 >= rate)
    for mark in MARKS:
        plain |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
    back = h4 % 100 < spm
    p, s, m = (pa.scalar(x, pa.large_string()) for x in MARKS)
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, empty)
    spm_ = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, empty)
    plain, back = pa.array(plain), pa.array(back)
    marked = pc.invert(plain)

    def chars(piece):
        return pc.if_else(marked, pc.utf8_length(piece).cast(pa.int64()), pa.scalar(None, pa.int64()))

    return pa.RecordBatch.from_arrays(
        [pa.array(n).cast(pa.int64()), pc.if_else(plain, "plain", pc.if_else(back, "spm", "psm")), chars(prefix), chars(middle),
         pc.if_else(plain, texts, pc.if_else(back, spm_, psm))], schema=OUT)


def restored(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The exact texts of outputs and forms: a marked output holds each mark once, and begins with one."""
    outputs = outputs.cast(pa.large_string())
    pieces = pc.split_pattern_regex(outputs, "<[PSM]>")
    marked = pc.not_equal(forms, "plain")
    flat, offs = pc.list_flatten(pieces), pieces.offsets.to_numpy()

    def piece(k):  # a plain output's may be another text's, and isn't used
        return flat.take(pa.array(np.minimum(offs[:-1] + k, len(flat) - 1)))

    first, second, middle = (piece(k) for k in (1, 2, 3))
    back = pc.equal(forms, "spm")
    prefix, suffix = pc.if_else(back, second, first), pc.if_else(back, first, second)
    return pc.if_else(marked, pc.binary_join_element_wise(prefix, middle, suffix, pa.scalar("", pa.large_string())), outputs)


def draws(doc_id: str = "doc_id", seed: int = SEED):
    """Four columns: the first groups of eight digits of the hex sha256 of ``seed:id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row per document."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).select("doc_id", "text", *draws("doc_id", seed))

    def run(batches):
        for batch in batches:
            for b in slices(batch, SLICE):
                out = transformed(b.column("text"), [b.column(f"h{k}").to_numpy() for k in range(1, 5)], rate, spm)
                columns = [out.column(i) for i in range(4)] + [out.column(4).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], ["doc_id", *OUT.names])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(outputs: DataFrame, output: str = "output", form: str = "form", to: str = "restored") -> DataFrame:
    """The table with a column ``to``: the text that an output was made of."""
    kept = [c for c in outputs.columns if c != to]
    rows = outputs.select(*[F.col(f"`{c}`") for c in kept])
    schema = ", ".join([f"`{c}` {kind}" for c, kind in rows.dtypes] + [f"`{to}` string"])

    def run(batches):
        for b in batches:
            if b.num_rows:
                text = restored(b.column(output), b.column(form)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns, text], [*kept, to])

    return rows.mapInArrow(run, schema)


def op11_fill_middle(spark, sf_dir: str) -> DataFrame:
    out = restore(fill_in_middle(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2("restored", 256).alias("restored_sha256"))


OP11_SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || CAST(doc_id AS varchar)) AS h
  FROM documents),
cut AS (
  SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS ubigint) % (len(units) + 1) AS one, CAST('0x' || h[9:16] AS ubigint) % (len(units) + 1) AS two
  FROM drawn),
pieces AS (
  SELECT doc_id, text, n, array_to_string(units[1:least(one, two)], '') AS prefix,
         array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle, array_to_string(units[greatest(one, two) + 1:], '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || h[17:24] AS ubigint) % 100 >= 100 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS ubigint) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""
