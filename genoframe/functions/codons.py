"""Coding sequences held against their proteins."""

from __future__ import annotations

from itertools import product

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Amino acids of the standard genetic code, codons in the order TTT, TTC, TTA, TTG, TCT, ...
STANDARD = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODE = dict(zip(map("".join, product("TCAG", repeat=3)), STANDARD))
#: Most bases that are taken out before a codon; from three on the amino acid after it must fit too.
MOST_SKIPPED, CHECKED_FROM = 4, 3
#: Sequences worked on at a time.
AT_ONCE = 64


def amino_acid(codon: str) -> str:
    return CODE.get(codon.upper().replace("U", "T"), "X")


def repaired(cds: str, protein: str) -> tuple[str, list[tuple[int, str]]]:
    """(sequence in frame, [(position, bases taken out)]): the fewest bases before each codon that bring it to its amino acid.

    X in the protein stands for any amino acid if the one after it fits. Raises ValueError where no codon fits.
    """
    codons, out, at = [], [], 0
    for j, want in enumerate(protein):
        after = protein[j + 1] if j + 1 < len(protein) else None
        for skip in range(MOST_SKIPPED + 1):
            start = at + skip
            if start + 3 > len(cds):
                continue
            goes_on = after is None or (start + 6 <= len(cds) and after in ("X", amino_acid(cds[start + 3 : start + 6])))
            if want == "X":
                fits = goes_on or amino_acid(cds[start : start + 3]) == "X" and skip < CHECKED_FROM
            else:
                fits = amino_acid(cds[start : start + 3]) == want and (goes_on or skip < CHECKED_FROM)
            if fits:
                if skip:
                    out.append((at, cds[at:start]))
                codons.append(cds[start : start + 3])
                at = start + 3
                break
        else:
            raise ValueError(f"no codon for amino acid {j + 1} ({want}) at base {at + 1}")
    return "".join(codons), out


def translate(cds: Column) -> Column:
    """Protein of whole codons."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else "".join(amino_acid(x[i : i + 3]) for i in range(0, len(x) - 2, 3)))

    return run(cds)


def repair_frames(rows: DataFrame, cds: str = "cds", protein: str = "protein") -> DataFrame:
    """rows with `repair`: struct of fixed, out (array of position and bases) and error, one of which is null."""

    kind = T._parse_datatype_string("fixed string, out array<struct<at:int,bases:string>>, error string")
    schema = T.StructType([*rows.schema.fields, T.StructField("repair", kind)])
    type_ = to_arrow_schema(schema).field("repair").type

    def one(s, p):
        try:
            fixed, out = repaired(s or "", (p or "").rstrip("*"))
            return {"fixed": fixed, "out": [{"at": a, "bases": b} for a, b in out], "error": None}
        except ValueError as e:
            return {"fixed": None, "out": None, "error": str(e)}

    # A few rows at a time: what is found for a batch of long sequences is many times their size in Python.
    def run(batches):
        for batch in batches:
            for k in range(0, len(batch), AT_ONCE):
                part = batch.slice(k, AT_ONCE)
                found = [one(s, p) for s, p in zip(part.column(cds).to_pylist(), part.column(protein).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, type_)], names=[*part.schema.names, "repair"])

    return rows.mapInArrow(run, schema)
