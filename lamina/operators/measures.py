"""Measurement rows: overrides, ratios, notes, actions and assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.operators import image, view
from lamina.operators import pixelmeasures as pm

#: Measures that one frame alone cannot take, with the reason.
UNMEASURABLE = {"g3": "needs rendered views", "g4": "needs rendered views", "g5": "needs a second render", "g6": "needs family textures", "g7": "needs family textures", "g8": "needs the view sheet"}


def overridden(own: Column, render: Column) -> Column:
    """Own measures with those of the renderer over them, where its key starts with g. Null maps are empty.

    Written as a filter of the own keys, so that no setting for repeated map keys is needed.
    """
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    theirs = F.map_filter(F.coalesce(render, none), lambda k, v: k.startswith("g"))
    mine = F.map_filter(F.coalesce(own, none), lambda k, v: ~F.coalesce(F.array_contains(F.map_keys(theirs), k), F.lit(False)))
    return F.map_concat(mine, theirs)


def albedo_ratio(rendered: Column, visible: Column) -> tuple[Column, Column]:
    """(ratio, note): null and a note where nothing is visible, or where either number is NaN or infinite."""
    none = F.coalesce(visible, F.lit(0.0)) == 0
    odd = lambda c: F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(False))
    bad = odd(rendered) | odd(visible)
    return F.when(~bad, F.round(F.try_divide(rendered, visible), 4)), F.when(bad, "albedo is no number").when(none, "no visible albedo").otherwise("")


def preparation_notes() -> Column:
    """What is to be said of a prepared mesh, in order."""
    return F.array_compact(
        F.array(
            F.when(F.col("uv_out_of_range"), "layout outside [0, 1], replaced"),
            F.when(F.lower(F.trim("uv_source")).isin("xatlas", "grid"), "layout made here"),
            F.when(F.col("overlap_texels") > 0, F.concat(F.col("overlap_texels").cast("string"), F.lit(" texels claimed twice"))),
            F.when(F.col("occupancy") < 0.05, "layout covers little of the atlas"),
        )
    )


def uv_provenance(c: Column) -> Column:
    """Where a layout came from; one made here if none was supplied."""
    s = F.lower(F.trim(c))
    return F.coalesce(F.when(s != "", s), F.lit("grid"))


def asked_key(delivery_key: Column, atlas_at: Column, delivered_at: Column) -> Column:
    """The key an object is asked for: its delivery key, and another one while the atlas is newer than what was delivered."""
    newer = F.coalesce(atlas_at > delivered_at, F.lit(False))
    return F.when(newer, F.concat(delivery_key, F.lit("|atlas-newer"))).otherwise(delivery_key)


def delivery_action(rows: DataFrame) -> DataFrame:
    """What is to be done with an object that is due: stale (its atlas was not completed at the current key), missing atlas,
    unchanged (the atlas has the digest of the last delivery, at the same delivery key), or deliver.

    rows: done_key, current_key, atlas (its digest), own_digest, own_delivery, delivery_key.
    """
    a = (
        F.when(~F.col("done_key").eqNullSafe(F.col("current_key")) | F.col("done_key").isNull(), "stale")
        .when(F.col("atlas").isNull(), "missing atlas")
        .when((F.col("own_digest") == F.col("atlas")) & (F.col("own_delivery") == F.col("delivery_key")), "unchanged")
        .otherwise("deliver")
    )
    return rows.withColumn("action", a)


def unmeasured(row: dict[str, Column]) -> Column:
    """Names of the gates for which no measure is there, ascending."""
    return F.array_sort(F.array_compact(F.array(*[F.when(c.isNull(), F.lit(k)) for k, c in row.items()])))


def unmeasured_because(names: Column) -> Column:
    """Reasons for the unmeasured gates that have one."""
    known = F.create_map(*[F.lit(x) for kv in UNMEASURABLE.items() for x in kv])
    return F.map_filter(known, lambda k, v: F.array_contains(names, k))


#: The columns of a measurement that a renderer may set, and the gates with the columns that show they were measured.
RENDERED = ["g1_dark_frac", "g1_max_blob", "g1_ref_dark", "g3_ratio", "g4_iou_min", "g4_iou_orig", "g5_valid_views", "g6_bad_fraction", "g7_ring_difference", "g8_psnr", "g8_psnr_flip"]
MEASURED_BY = {"g1_ref_dark": ["g1_ref_dark", "g1_ref_foreground_px"], "g3": ["g3_ratio", "g3_note"], "g4": ["g4_iou_min", "g4_iou_orig"], "g5": ["g5_valid_views"], "g6": ["g6_bad_fraction"], "g7": ["g7_ring_difference"], "g8": ["g8_psnr", "g8_psnr_flip", "g8_views"]}


def sheet_agreement(mesh: tuple[DataFrame, DataFrame, DataFrame, DataFrame], texture: DataFrame, sheet: DataFrame, res: int) -> DataFrame:
    """(uid, g8_psnr, g8_psnr_flip, g8_views, g8_views_measured, g8_exact_views, g8_iou): the texture rendered into the six
    views, as it is and upside down, against the generator's sheet. Masks under 100 pixels are void.

    mesh: vertices, faces, uv_vertices, uv_faces; texture and sheet (uid, y, x, r, g, b). Objects that lack one of them have no row.
    """
    v, f, uv, uf = mesh
    have = sheet.select("uid").distinct().join(texture.select("uid").distinct(), "uid", "left_semi").join(f.select("uid").distinct(), "uid", "left_semi").join(uf.select("uid").distinct(), "uid", "left_semi")
    size = lambda p: p.groupBy("uid").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    sheet, f = (x.join(have, "uid", "left_semi") for x in (sheet, f))
    nv = view.normalized(v.join(have, "uid", "left_semi"))
    frags = view.fragments(nv, f, view.camera_table(v.sparkSession, view.box_cameras()), res).join(size(texture), "uid")
    rendered = view.emission(frags, uv, uf, texture, F.col("w"), F.col("h"), None)
    tiles = view.sheet_tiles(sheet, size(sheet)).withColumnRenamed("tile", "view")
    fit = (F.col("th") == res) & (F.col("tw") == res)
    name = F.concat_ws("|", "view", "uid")
    other = image.resized(tiles.filter(~fit).select(name.alias("img"), "y", "x", "r", "g", "b"), res, "cubic")
    part = F.split("img", r"\|", 2)
    at = ["uid", "view", "y", "x"]
    tiles = tiles.filter(fit).select(*at, "r", "g", "b").unionByName(other.select(part[1].alias("uid"), part[0].cast("long").alias("view"), "y", "x", "r", "g", "b"))
    truth = view.tile_foreground(tiles.withColumns({"th": F.lit(res), "tw": F.lit(res)}), ["uid", "view"]).select(*at, "fg", *[F.col(c).alias(f"t{c}") for c in "rgb"])
    return pm.agreement(pm.compared_views(truth, rendered), "uid")


def resolved_families(families: DataFrame, uv: DataFrame, uf: DataFrame, texture: DataFrame) -> DataFrame:
    """(uid, family_resolve): for each family of an object the share of its texels that the texture paints.

    families(uid, family, i, face_id, b0, b1, b2); objects with fewer than two families have no row, as in the source.
    """
    many = families.groupBy("uid").agg(F.count_distinct("family").alias("n")).filter("n >= 2").select("uid")
    p = image.sampled_families(families.join(many, "uid", "left_semi"), uv, uf, texture)
    return pm.family_resolve(p, ["uid"]).groupBy("uid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("family", "resolved")))).alias("family_resolve"))


def assembled(pixels: DataFrame, grid: DataFrame, references: DataFrame | None = None, agreement: DataFrame | None = None, resolved: DataFrame | None = None, bless: DataFrame | None = None, render: DataFrame | None = None, margin: int = 4) -> DataFrame:
    """One measurement row per image, from what is there for it; `unmeasured` names what is absent.

    references(uid, y, x, r, g, b), agreement as sheet_agreement, resolved as resolved_families, bless(uid, note),
    render(uid, measures map<string, double>, note): numbers of a renderer over the own ones. uid is img as text.
    margin: the ring the textures were delivered with.
    """
    rows = pm.dark_coverage(pixels, grid).join(image.ring_consistency(pixels, grid, margin), "img").join(pm.dark_blobs(pixels, grid).select("img", "g1_max_blob"), "img", "left")
    error = F.when((F.col("ring_difference") > 0) | (F.col("far_background") > 0), "ring or background differs from the margin rule")
    rows = rows.withColumns({"uid": F.col("img").cast("string"), "error": error, "g1_max_blob": F.coalesce("g1_max_blob", F.lit(0.0))})
    none = lambda kind: F.lit(None).cast(kind)

    def add(rows: DataFrame, extra: DataFrame | None, columns: dict[str, str]) -> DataFrame:
        if extra is None:
            return rows.withColumns({c: none(k) for c, k in columns.items()})
        return rows.join(extra.select(F.col("uid").cast("string").alias("uid"), *columns), "uid", "left")

    if references is not None:
        references = references.withColumnRenamed("uid", "img")
        references = pm.reference_dark(references, image.sizes(references)).withColumnRenamed("img", "uid")
    rows = add(rows, references, {"g1_ref_dark": "double", "g1_ref_foreground_px": "long"})
    rows = add(rows, agreement, {"g8_psnr": "double", "g8_psnr_flip": "double", "g8_views": "long", "g8_views_measured": "long", "g8_exact_views": "long", "g8_iou": "double"})
    rows = add(rows, resolved, {"family_resolve": "map<string,double>"})
    if bless is not None:
        note = F.when(F.trim("note") != "", F.col("note"))
        bless = bless.groupBy("uid").agg(F.coalesce(F.max(note), F.lit("no note recorded")).alias("g1_bless_note"))
    rows = add(rows, bless, {"g1_bless_note": "string"})
    rows = add(rows, None if render is None else render.withColumnRenamed("note", "g3_note"), {"measures": "map<string,double>", "g3_note": "string"})
    own = F.map_from_entries(F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v"))) for c in ("g1_dark_frac", "g1_max_blob", "g1_ref_dark", "g8_psnr", "g8_psnr_flip")])))
    rows = rows.withColumn("_m", overridden(own, F.col("measures")))
    rows = rows.withColumns({c: F.col("_m")[c].cast("int" if c == "g5_valid_views" else "double") for c in RENDERED})
    names = unmeasured({g: F.coalesce(*[F.col(c).cast("string") for c in by]) for g, by in MEASURED_BY.items()})
    rows = rows.withColumn("unmeasured", names)
    rows = rows.withColumns({"g1_bless": F.col("g1_bless_note").isNotNull(), "g3_note": F.coalesce("g3_note", F.lit("")), "unmeasured_because": unmeasured_because(F.col("unmeasured"))})
    return rows.drop("_m", "measures")
