"""Per-document image-augmentation plan (what to apply, with which parameters).

The reference draws a chain of augmentations per document in three phases
(ink, paper, post). Each op is gated by a probability; a OneOf group is gated
once and then exactly one member runs, chosen in proportion to the members'
own probabilities (an unset probability counts as 1). Scalar parameters drawn
per document get a keyed value; range parameters are passed on as (lo, hi);
constants are written as text. Applying the ops to pixels is a renderer's job.

The plan is one projection and one explode per document row: no join, no
shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import u01

@dataclass(frozen=True)
class Param:
    name: str
    kind: str              # 'uniform' | 'randint' | 'choice' | 'range' | 'fixed'
    lo: float | None = None
    hi: float | None = None
    choices: tuple = ()
    value: str | None = None


@dataclass(frozen=True)
class Op:
    phase: str
    slot: int
    op: str
    p: float | None        # multiple of the strength P; None = library default (1.0)
    group: str | None = None
    group_p: float | None = None
    params: tuple = field(default_factory=tuple)


def R(name, lo, hi):
    return Param(name, "range", lo, hi)


def U(name, lo, hi):
    return Param(name, "uniform", lo, hi)


def I(name, lo, hi):  # noqa: E743
    return Param(name, "randint", lo, hi)


def C(name, *choices):
    return Param(name, "choice", choices=tuple(choices))


def K(name, value):
    return Param(name, "fixed", value=str(value))


# The reference's augmentation chain. p and group_p are
# multiples of the strength P (e.g. 0.25 means P/4); None means the library
# default. Ranges, draws and constants as in the reference.
CATALOG = (
    Op("ink", 1, "Dithering", 1 / 4, "ink_oneof", 1 / 2),
    Op("ink", 1, "BleedThrough", 1 / 4, "ink_oneof", 1 / 2, (
        R("intensity_range", 0.05, 0.1), R("color_range", 64, 192), U("alpha", 0.05, 0.1),
        K("offsets", "(5, 10)"))),
    Op("ink", 1, "InkBleed", 1 / 4, "ink_oneof", 1 / 2, (
        R("intensity_range", 0.2, 0.3), C("kernel_size", "(1, 1)", "(3, 3)"), R("severity", 0.1, 0.2))),
    Op("paper", 1, "ColorPaper", 1 / 10),
    Op("paper", 2, "DelaunayTessellation", 1 / 3, "paper_oneof", 1 / 2),
    Op("paper", 2, "PatternGenerator", 1 / 3, "paper_oneof", 1 / 2, (R("alpha_range", 0.1, 0.25),)),
    Op("paper", 2, "VoronoiTessellation", 1 / 3, "paper_oneof", 1 / 2),
    Op("paper", 3, "NoiseTexturize", 1 / 2, None, None, (R("sigma_range", 1, 5), R("turbulence_range", 2, 3))),
    Op("paper", 4, "BrightnessTexturize", 1 / 2, None, None, (R("texturize_range", 0.95, 0.99), K("deviation", 0.01))),
    Op("post", 1, "DirtyDrum", 1 / 4, "post_oneof_1", 1 / 4, (
        R("line_width_range", 1, 3), U("line_concentration", 0.02, 0.05), I("direction", 0, 2),
        U("noise_intensity", 0.3, 0.5), R("noise_value", 128, 192), C("ksize", "(3, 3)"), K("sigmaX", 0))),
    Op("post", 1, "DirtyRollers", None, "post_oneof_1", 1 / 4, (
        R("line_width_range", 1, 16), K("scanline_type", 0))),
    Op("post", 2, "SubtleNoise", 1 / 4, None, None, (I("subtle_range", 1, 5),)),
    Op("post", 3, "Jpeg", 1 / 2, None, None, (R("quality_range", 50, 95),)),
    Op("post", 4, "Markup", None, "post_oneof_2", 1 / 4, (
        R("num_lines_range", 1, 3), R("markup_length_range", 0.25, 0.5), R("markup_thickness_range", 1, 2),
        C("markup_type", "strikethrough", "crossed", "highlight", "underline"), K("markup_color", "random"),
        K("single_word_mode", False), K("repetitions", 1))),
    Op("post", 4, "Scribbles", None, "post_oneof_2", 1 / 4, (
        K("scribbles_type", "random"), K("scribbles_location", "random"), R("scribbles_size_range", 100, 300),
        R("scribbles_count_range", 1, 3), R("scribbles_thickness_range", 1, 3),
        K("scribbles_brightness_change", "[32, 64]"), K("scribbles_text", "random"),
        K("scribbles_text_font", "random"), R("scribbles_text_rotate_range", 0, 180),
        R("scribbles_lines_stroke_count_range", 1, 3))),
    Op("post", 5, "ColorShift", 1 / 4, None, None, (
        R("color_shift_offset_x_range", 1, 2), R("color_shift_offset_y_range", 1, 2),
        R("color_shift_iterations", 1, 2), R("color_shift_brightness_range", 0.95, 1.05),
        R("color_shift_gaussian_kernel_range", 3, 3))),
    Op("post", 6, "BadPhotoCopy", None, None, None, (
        K("noise_type", -1), K("noise_side", "random"), R("noise_iteration", 1, 1), R("noise_size", 1, 2),
        R("noise_value", 160, 196), R("noise_sparsity", 0.1, 0.3), R("noise_concentration", 0.05, 0.3),
        C("blur_noise", "True", "False"), C("blur_noise_kernel", "(3, 3)", "(5, 5)"),
        C("wave_pattern", "True", "False"), C("edge_effect", "True", "False"))),
    Op("post", 7, "Faxify", 1 / 3, None, None, (
        R("scale_range", 0.1, 0.3), C("monochrome", "0", "1"), K("monochrome_method", "random"),
        K("monochrome_arguments", "{}"), C("halftone", "0", "1"), K("invert", 1),
        C("half_kernel_size", "(1, 1)", "(2, 2)"), R("angle", 0, 180), R("sigma", 1, 3))),
)


def op_probability(op: Op, probability: float) -> float:
    return 1.0 if op.p is None else op.p * probability


def group_members(group: str) -> list[Op]:
    return [o for o in CATALOG if o.group == group]


def member_interval(op: Op, probability: float) -> tuple[float, float]:
    """[lo, hi) of the member's share of its OneOf group (in catalog order)."""
    members = group_members(op.group)
    weights = [op_probability(m, probability) for m in members]
    total = sum(weights)
    i = members.index(op)
    lo = sum(weights[:i]) / total
    hi = sum(weights[:i + 1]) / total if i < len(members) - 1 else 1.0
    return lo, hi


def expected_rate(op: Op, probability: float) -> float:
    if op.group is None:
        return min(1.0, op_probability(op, probability))
    lo, hi = member_interval(op, probability)
    return min(1.0, op.group_p * probability) * (hi - lo)


def gate_threshold(op: Op, probability: float) -> float:
    return op.group_p * probability if op.group else op_probability(op, probability)


def _op_structs(probability: float) -> Column:
    """The catalog as a literal array: one struct per op with its gate
    threshold, OneOf share and a nested array of parameter structs."""
    null_d, null_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    ops = []
    for order, op in enumerate(CATALOG):
        plo, phi = member_interval(op, probability) if op.group else (None, None)
        params = []
        for prm in (op.params or (None,)):
            params.append(F.struct(
                (F.lit(prm.name) if prm else null_s).alias("param"),
                (F.lit(prm.kind) if prm else null_s).alias("kind"),
                (F.lit(float(prm.lo)) if prm and prm.lo is not None else null_d).alias("lo"),
                (F.lit(float(prm.hi)) if prm and prm.hi is not None else null_d).alias("hi"),
                F.array(*[F.lit(c) for c in (prm.choices if prm and prm.choices else ("",))]).alias("choices"),
                (F.lit(prm.value) if prm and prm.value is not None else null_s).alias("fixed")))
        ops.append(F.struct(
            F.lit(order).alias("order"), F.lit(op.phase).alias("phase"), F.lit(op.slot).alias("slot"),
            F.lit(op.op).alias("op"), (F.lit(op.group) if op.group else null_s).alias("grp"),
            F.lit(gate_threshold(op, probability)).alias("thr"),
            (F.lit(plo) if plo is not None else null_d).alias("plo"),
            (F.lit(phi) if phi is not None else null_d).alias("phi"),
            F.array(*params).alias("params")))
    return F.array(*ops)


def _is_active(o: Column, doc: Column, seed: int) -> Column:
    own = u01(seed, doc, "aug", o["op"], "gate") < o["thr"]
    pick = u01(seed, doc, "aug", o["grp"], "pick")
    grouped = (u01(seed, doc, "aug", o["grp"], "gate") < o["thr"]) & (pick >= o["plo"]) & (pick < o["phi"])
    return F.when(o["grp"].isNull(), own).otherwise(grouped)


def augmentation_plan(docs: DataFrame, probability: float = 0.5, seed: int = 0,
                      doc_col: str = "doc_id") -> DataFrame:
    """Rows ``(doc, step, phase, slot, op, param, lo, hi, value_num, value)``
    for the ops active in each document; ``step`` numbers the active ops in
    phase order (1-based); an op without parameters has one row with null
    ``param``.

    Per document the literal op array is filtered by each op's gate (every
    gate drawn once), the active ops are exploded with their position as the
    step, then their parameters are exploded and drawn.
    """
    doc = F.col(doc_col).cast("string")
    active = F.filter(_op_structs(probability), lambda o: _is_active(o, doc, seed))
    d = docs.select(F.col(doc_col), F.posexplode(active).alias("_ds_step", "_ds_op"))
    d = d.select(F.col(doc_col), (F.col("_ds_step") + 1).cast("int").alias("step"), F.col("_ds_op.phase"),
                 F.col("_ds_op.slot"), F.col("_ds_op.op"), F.explode(F.col("_ds_op.params")).alias("_ds_p"))
    c = F.col("_ds_p")
    u = u01(seed, doc, "aug", F.col("op"), c["param"])
    kind = c["kind"]
    span = c["hi"] - c["lo"]
    value_num = (F.when(kind == "uniform", c["lo"] + u * span)
                 .when(kind == "randint", (c["lo"].cast("bigint")
                                           + F.floor(u * (span.cast("bigint") + F.lit(1)))).cast("double")))
    value = (F.when(kind == "choice", F.element_at(c["choices"], F.floor(u * F.size(c["choices"])).cast("int") + 1))
             .when(kind == "fixed", c["fixed"]))
    is_range = kind == "range"
    return d.select(F.col(doc_col), "step", "phase", "slot", "op", c["param"].alias("param"),
                    F.when(is_range, c["lo"]).alias("lo"), F.when(is_range, c["hi"]).alias("hi"),
                    value_num.alias("value_num"), value.alias("value"))


def plan_audit(plan: DataFrame, n_docs: int, probability: float = 0.5) -> DataFrame:
    """Activation count and rate per op next to the rate the catalog implies.

    An active op has one row per parameter; counting only its first parameter
    row (known from the catalog) counts each activation once, without a
    per-document grouping.
    """
    first = {o.op: (o.params[0].name if o.params else None) for o in CATALOG}
    first_map = F.create_map(*[x for k, v in first.items() if v is not None for x in (F.lit(k), F.lit(v))])
    one_row = F.col("param").eqNullSafe(first_map[F.col("op")])
    counts = plan.filter(one_row).groupBy("op").agg(F.count(F.lit(1)).alias("n_active"))
    ops = F.array(*[F.struct(F.lit(o.op).alias("op"), F.lit(expected_rate(o, probability)).alias("expected_rate"))
                    for o in CATALOG])
    catalog = plan.sparkSession.range(1).select(F.inline(ops))  # every op, also one that never fired
    n = F.coalesce(F.col("n_active"), F.lit(0)).cast("bigint")
    return catalog.join(counts, "op", "left").select(
        "op", n.alias("n_active"), F.try_divide(n, F.lit(int(n_docs))).alias("rate"), "expected_rate")
