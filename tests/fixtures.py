"""A small dataset with the shapes and edge cases the operators must get right."""

from cellshift import model

TYPES = ("T_cell", "B_cell")


def cells(spark):
    """Twelve cells, three donors; the last cell has no donor and the last two no entries."""
    rows = [
        (f"cell_{i:06d}", TYPES[i % 2], f"donor_{i % 3 + 1:02d}" if i < 11 else None, f"batch_{i % 2 + 1:02d}")
        for i in range(12)
    ]
    return spark.createDataFrame(rows, model.CELLS)


def genes(spark):
    rows = [(f"GENE{g:04d}", str(g), f"ENSGSIM{g:011d}", True) for g in range(1, 6)]
    return spark.createDataFrame(rows, model.GENES)


def values():
    """(cell, gene) to value; a zero where cell + gene is a multiple of four."""
    return {
        (f"cell_{i:06d}", f"GENE{g:04d}"): float((i * 7 + g * 3) % 9 + 1)
        for i in range(10)
        for g in range(1, 6)
        if (i + g) % 4
    }


def expression(spark):
    return spark.createDataFrame([(c, g, v) for (c, g), v in values().items()], model.EXPRESSION)


SPECS = [
    # type, gene, genes, fold_change, delta, donors, cell types
    ("gene_knockout", "GENE0001", None, None, None, None, None),
    ("gene_overexpression", "GENE0003", None, 2.5, None, None, ["T_cell"]),
    ("gene_activation", "GENE0002", None, None, 0.35, ["donor_02"], None),
    (" Gene_Knockout\t", None, ["GENE0004", "GENE0004", "GENE9999"], None, None, ["donor_01"], ["T_cell"]),
    ("gene_activation", "GENE0005", None, None, -3.0, None, None),
    ("gene_activation", "GENE0005", None, 4.0, 0.0, [], None),
    ("gene_overexpression", "GENE0001", None, 0.5, None, None, None),
    ("gene_overexpression", "GENE0002", None, None, None, None, []),
    ("GENE_ACTIVATION", "GENE0001", None, None, None, ["donor_03", "donor_03"], None),
    ("gene_overexpression", "GENE0004", None, float("nan"), None, None, None),
]


def specs(spark, rows=SPECS):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("position", T.LongType()), *model.SPEC_ENTRY.fields])
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


# --- the same in plain Python, written from the rules ------------------------


def in_cohort(cell, donors, kinds):
    i = int(cell[-6:])
    donor = f"donor_{i % 3 + 1:02d}" if i < 11 else None
    return (donors is None or donor in donors) and (kinds is None or TYPES[i % 2] in kinds)


def perturbed(spec):
    """The dense matrix after one experiment."""
    kind, gene, genes_, fold, delta, donors, kinds = spec
    kind = kind.strip().lower()
    known = {f"GENE{g:04d}" for g in range(1, 6)}
    named = {g for g in (genes_ if genes_ is not None else [gene]) if g in known}
    base = values()
    out = {}
    for i in range(12):
        cell = f"cell_{i:06d}"
        for g in known:
            v = base.get((cell, g), 0.0)
            if g in named and in_cohort(cell, donors, kinds):
                if kind == "gene_knockout":
                    v = 0.0
                elif kind == "gene_activation" and delta is not None:
                    v = max(0.0, v + delta)
                else:
                    v *= max(1.0, fold if fold is not None else {"gene_overexpression": 2.0}.get(kind, 1.5))
            if v:
                out[(cell, g)] = v
    return out
