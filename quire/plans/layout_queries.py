"""Queries of geometry, pictures, older documents, cropping and chunks, with oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import assets, chunking, cropping, legacy, pictures
from . import bridge as V

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(oracle: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return put


def _share(lo: str, hi: str, a: str, b: str) -> str:
    """Overlap of [lo, hi] of boxes a and b over the lesser extent."""
    least = f"least({a}.{hi} - {a}.{lo}, {b}.{hi} - {b}.{lo})"
    return f"CASE WHEN {least} > 0 THEN greatest(0.0, least({a}.{hi}, {b}.{hi}) - greatest({a}.{lo}, {b}.{lo})) / {least} ELSE 0.0 END"


def _v(a: str, b: str) -> str:
    return _share("b", "t", a, b)


def _h(a: str, b: str) -> str:
    return _share("l", "r", a, b)


def _dist(a: str, b: str) -> str:
    dx, dy = f"(({a}.l + {a}.r) / 2 - ({b}.l + {b}.r) / 2)", f"(({a}.t + {a}.b) / 2 - ({b}.t + {b}.b) / 2)"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def _edge(a: str, b: str) -> str:
    return f"least(abs({a}.b - {b}.t), abs({b}.b - {a}.t), abs({a}.r - {b}.l), abs({b}.r - {a}.l))"


def _ratio(x: str, y: str) -> str:
    return f"CASE WHEN greatest({x}, {y}) > 0 THEN least({x}, {y}) / greatest({x}, {y}) ELSE 0.0 END"


def _split(a: str, b: str) -> str:
    wide = f"{_v(a, b)} > 0.8 AND {_ratio(f'({a}.t - {a}.b)', f'({b}.t - {b}.b)')} > 0.85 AND least(abs({a}.r - {b}.l), abs({b}.r - {a}.l)) < 40"
    tall = f"{_h(a, b)} > 0.8 AND {_ratio(f'({a}.r - {a}.l)', f'({b}.r - {b}.l)')} > 0.85 AND least(abs({a}.b - {b}.t), abs({b}.b - {a}.t)) < 40"
    return f"CASE WHEN {wide} THEN 'horizontal' WHEN {tall} THEN 'vertical' END"


_BELOW, _LEFT, _RIGHT = "CASE WHEN c.t <= p.b + 20 THEN greatest(0.0, p.b - c.t) END", "CASE WHEN c.r <= p.l + 20 THEN greatest(0.0, p.l - c.r) END", "CASE WHEN c.l >= p.r - 20 THEN greatest(0.0, c.l - p.r) END"
_PICS = f"""WITH {V.SQL_BOXES},
    pics AS (SELECT doc_id, page, ord, l, t, r, b, width, height, number AS cn, width >= 150 AND height >= 150 AS ok FROM boxes WHERE NOT is_caption),
    caps AS (SELECT doc_id, page, ord, l, t, r, b, CAST(ord % 4 + 1 AS INTEGER) AS number FROM boxes WHERE is_caption)"""


@register(f"""{_PICS} SELECT p.doc_id, p.page, p.ord, c.ord AS cap_ord, round({_v('p', 'c')}, 9) AS v, round({_h('p', 'c')}, 9) AS h, {_BELOW} AS below, {_LEFT} AS beside_left, {_RIGHT} AS beside_right, round({_dist('p', 'c')}, 6) AS dist, {_edge('p', 'c')} AS edge,
    abs(p.b - c.t) AS up, abs((p.l + p.r) / 2 - (c.l + c.r) / 2) AS across, {_split('p', 'c')} AS panels, round(p.t - p.b, 3) AS tall, round(p.r - p.l, 3) AS wide FROM pics p JOIN caps c USING (doc_id, page)""")
def box_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = V.captions(spark, sf_dir).select("doc_id", "page", F.col("ord").alias("cap_ord"), F.col("bbox").alias("c"))
    met = V.pictures(spark, sf_dir).join(c, ["doc_id", "page"])
    a, b = F.col("bbox"), F.col("c")
    return met.select(
        "doc_id", "page", "ord", "cap_ord", F.round(G.vertical_overlap(a, b), 9).alias("v"), F.round(G.horizontal_overlap(a, b), 9).alias("h"), G.gap_below(a, b).alias("below"), G.gap_left(a, b).alias("beside_left"), G.gap_right(a, b).alias("beside_right"),
        F.round(G.center_distance(a, b), 6).alias("dist"), G.edge_gap(a, b).alias("edge"), G.caption_gaps(a, b)["vertical"].alias("up"), G.caption_gaps(a, b)["horizontal"].alias("across"), G.split_orientation(a, b).alias("panels"),
        G.dimensions(a)["height"].alias("tall"), G.dimensions(a)["width"].alias("wide"),
    )


_USED = f"""{_PICS}, pk AS (SELECT doc_id, page, cn AS number, row_number() OVER (PARTITION BY doc_id, page, cn ORDER BY ord) AS k FROM pics WHERE ok AND cn IS NOT NULL),
    ck AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page, number ORDER BY ord) AS k FROM caps), used AS (SELECT ck.*, pk.k IS NOT NULL AS used FROM ck LEFT JOIN pk USING (doc_id, page, number, k))"""


@register(f"{_USED} SELECT doc_id, page, ord, number, used FROM used")
def caption_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pictures.used_captions(pictures.saveable(V.pictures(spark, sf_dir)), V.captions(spark, sf_dir)).select("doc_id", "page", "ord", F.col("number").cast("int").alias("number"), "used")


_NEAR = f"""{_USED}, g AS (SELECT p.doc_id, p.page, p.ord, c.ord AS cap_ord, c.number AS cap_number, {_BELOW} AS gb, {_LEFT} AS gl, {_RIGHT} AS gr, {_h('p', 'c')} AS h, {_v('p', 'c')} AS v, {_dist('p', 'c')} AS d
        FROM pics p JOIN used c USING (doc_id, page) WHERE NOT c.used AND p.ok AND p.cn IS NULL),
    sc AS (SELECT *, CASE WHEN gb IS NOT NULL AND h >= 0.4 THEN gb + 0.15 * d END AS s0, CASE WHEN gl IS NOT NULL AND v >= 0.4 THEN gl + 0.25 * d + 10 END AS s1, CASE WHEN gr IS NOT NULL AND v >= 0.4 THEN gr + 0.25 * d + 10 END AS s2 FROM g),
    bs AS (SELECT *, least(s0, s1, s2) AS s FROM sc), pl AS (SELECT *, CASE WHEN s0 = s THEN 'below' WHEN s1 = s THEN 'left' ELSE 'right' END AS placement FROM bs WHERE s IS NOT NULL),
    okp AS (SELECT * FROM pl WHERE CASE placement WHEN 'below' THEN gb <= 120 WHEN 'left' THEN gl <= 220 ELSE gr <= 220 END),
    near AS (SELECT * FROM okp QUALIFY row_number() OVER (PARTITION BY doc_id, page, ord ORDER BY s, cap_ord) = 1)"""


@register(f"{_NEAR} SELECT doc_id, page, ord, cap_ord, CAST(cap_number AS INTEGER) AS cap_number, placement, round(s, 6) AS score FROM near")
def nearby_caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pictures.saveable(V.pictures(spark, sf_dir))
    got = pictures.nearest_captions(p.where("saveable and caption_number is null"), pictures.used_captions(p, V.captions(spark, sf_dir)))
    return got.select("doc_id", "page", "ord", "cap_ord", F.col("cap_number").cast("int").alias("cap_number"), "placement", F.round("score", 6).alias("score"))


_DONOR = f"""dg AS (SELECT p.doc_id, p.page, p.ord, c.ord AS donor_ord, c.cn AS donor_number, {_edge('p', 'c')} AS gap FROM pics p JOIN pics c USING (doc_id, page)
        WHERE p.ok AND p.cn IS NULL AND NOT c.ok AND c.cn IS NOT NULL AND NOT ({_h('p', 'c')} < 0.3 AND {_v('p', 'c')} < 0.3 AND {_edge('p', 'c')} > 120)),
    donor AS (SELECT * FROM dg QUALIFY row_number() OVER (PARTITION BY doc_id, page, ord ORDER BY gap, donor_ord) = 1)"""


@register(f"{_PICS}, {_DONOR} SELECT doc_id, page, ord, donor_ord, donor_number, gap FROM donor")
def caption_donor(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pictures.saveable(V.pictures(spark, sf_dir))
    return pictures.caption_donors(p.where("saveable and caption_number is null"), p.where("not saveable")).select("doc_id", "page", "ord", "donor_ord", "donor_number", "gap")


_PART = f"""pt AS (SELECT * FROM (SELECT p.doc_id, p.page, p.ord, c.ord AS target_ord, c.cn AS target_number, {_split('p', 'c')} AS orientation, p.l AS pl, p.t AS pt, c.l AS cl, c.t AS ct, p.width AS pw, p.height AS ph, c.width AS cw, c.height AS ch
        FROM pics p JOIN pics c USING (doc_id, page) WHERE p.ok AND p.cn IS NULL AND c.ok AND c.cn IS NOT NULL) WHERE orientation IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, page, ord ORDER BY target_ord) = 1)"""


@register(f"""{_PICS}, {_PART} SELECT doc_id, page, target_ord, ord, target_number, orientation, CASE WHEN CASE orientation WHEN 'horizontal' THEN cl <= pl ELSE ct >= pt END THEN target_ord ELSE ord END AS first_ord,
    CAST(CASE orientation WHEN 'horizontal' THEN pw + cw ELSE greatest(pw, cw) END AS INTEGER) AS out_width, CAST(CASE orientation WHEN 'horizontal' THEN greatest(ph, ch) ELSE ph + ch END AS INTEGER) AS out_height
    FROM pt QUALIFY row_number() OVER (PARTITION BY doc_id, page, target_ord ORDER BY ord DESC) = 1""")
def split_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pictures.saveable(V.pictures(spark, sf_dir))
    partners = pictures.split_partners(p.where("saveable and caption_number is null"), p.where("saveable and caption_number is not null"))
    return pictures.stitch_plan(partners, p)


_OUTCOME = f"""{_NEAR}, {_DONOR}, {_PART}, oc AS (SELECT p.doc_id, p.page, p.ord, p.cn, near.cap_number, donor.donor_number, pt.target_number,
        CASE WHEN NOT p.ok THEN 'discarded' WHEN tg.target_ord IS NOT NULL THEN 'stitched' WHEN p.cn IS NOT NULL THEN 'own' WHEN pt.target_ord IS NOT NULL THEN 'merged' WHEN near.cap_number IS NOT NULL THEN 'nearby' WHEN donor.donor_number IS NOT NULL THEN 'donor' ELSE 'no_caption' END AS outcome
        FROM pics p LEFT JOIN near USING (doc_id, page, ord) LEFT JOIN donor USING (doc_id, page, ord) LEFT JOIN pt USING (doc_id, page, ord) LEFT JOIN (SELECT DISTINCT doc_id, page, target_ord FROM pt) tg ON tg.doc_id = p.doc_id AND tg.page = p.page AND tg.target_ord = p.ord),
    oc2 AS (SELECT doc_id, page, ord, outcome, CAST(CASE outcome WHEN 'merged' THEN target_number WHEN 'discarded' THEN NULL ELSE coalesce(cn, cap_number, donor_number) END AS INTEGER) AS number FROM oc)"""


@register(f"{_OUTCOME} SELECT * FROM oc2")
def picture_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pictures.reconcile(V.pictures(spark, sf_dir), V.captions(spark, sf_dir))


@register(f"""{_OUTCOME}, fl AS (SELECT doc_id, page, ord, 'images/' || coalesce(CAST(number AS VARCHAR), 'no_cap_' || ord) || '.png' AS file, CASE outcome WHEN 'stitched' THEN 1 WHEN 'own' THEN 2 WHEN 'no_caption' THEN 4 ELSE 3 END AS step FROM oc2 WHERE outcome NOT IN ('discarded', 'merged'))
    SELECT doc_id, page, file, ord FROM fl QUALIFY row_number() OVER (PARTITION BY doc_id, page, file ORDER BY step DESC, ord DESC) = 1""")
def picture_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pictures.saved_files(picture_reconcile(spark, sf_dir))


@register(f"{_PICS} SELECT doc_id, page, count(*) FILTER (WHERE ok) AS n_valid, count(*) FILTER (WHERE ok AND cn IS NOT NULL) AS n_resolved, count(*) FILTER (WHERE ok AND cn IS NULL) AS n_unresolved, count(*) FILTER (WHERE NOT ok) AS n_discarded FROM pics GROUP BY ALL")
def picture_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pictures.page_stats(V.pictures(spark, sf_dir))


@register(r"""WITH k AS (SELECT doc_id AS d, doc_id // 12 AS doc_id, CAST(doc_id % 12 AS INTEGER) AS ord, coalesce(text, '') AS s FROM documents), x AS (SELECT *, CASE d % 3 WHEN 0 THEN 'Figure ' || (d % 5) || '. ' || s WHEN 1 THEN s ELSE 'Fig ' || (d % 7) END AS txt FROM k),
    ch AS (SELECT doc_id, ord, unnest([(ord + 1) % 12, (ord + 5) % 12]) AS child, unnest([0, 1]) AS child_ord FROM k), m AS (SELECT ch.doc_id, ch.ord, ch.child_ord, x.d, TRY_CAST(nullif(regexp_extract(x.txt, '^(?:Figure|Fig) ([0-9]+)', 1), '') AS INTEGER) AS n FROM ch JOIN x ON x.doc_id = ch.doc_id AND x.ord = ch.child)
    SELECT doc_id, ord, n AS caption_number FROM m WHERE n IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, ord ORDER BY child_ord) = 1""")
def linked_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    ord_ = F.expr("cast(doc_id % 12 as int)")
    s = F.coalesce("text", F.lit(""))
    txt = F.when(d % 3 == 0, F.concat(F.lit("Figure "), (d % 5).cast("string"), F.lit(". "), s)).when(d % 3 == 1, s).otherwise(F.concat(F.lit("Fig "), (d % 7).cast("string")))
    rows = V.table(spark, sf_dir, "documents")
    texts = rows.select(F.expr("doc_id div 12").alias("doc_id"), F.lit(1).alias("page"), ord_.alias("ord"), F.concat(F.lit("#/texts/"), ord_.cast("string")).alias("self_ref"), txt.alias("text"))
    ref = lambda k: F.concat(F.lit("#/texts/"), ((ord_ + k) % 12).cast("string"))
    pics = rows.select(F.expr("doc_id div 12").alias("doc_id"), F.lit(1).alias("page"), ord_.alias("ord"), F.array(ref(1), ref(5)).alias("child_refs"))
    return pictures.linked_captions(pics, texts).select("doc_id", "ord", "caption_number")


@register(r"""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'Table ' || (doc_id % 9) || ' x' WHEN doc_id % 4 = 1 THEN '' END AS cap, CASE WHEN doc_id % 3 = 0 THEN 'Table 77 before' END AS prev, [CASE WHEN doc_id % 5 < 3 THEN '' ELSE ' cell: ' || (doc_id % 13) || '/a ' END, 'Table 5'] AS cells FROM documents),
    c AS (SELECT doc_id, unnest(cells) AS txt, unnest([0, 1]) AS cell_ord FROM t), i AS (SELECT doc_id, cell_ord, CASE WHEN regexp_matches(trim(txt), '^Table [0-9]+') THEN regexp_extract(trim(txt), '^Table ([0-9]+)', 1) WHEN trim(txt) <> '' THEN regexp_replace(substr(regexp_replace(trim(txt), '[\\/*?:"<>| ]', '_', 'g'), 1, 50), '^_+|_+$', '', 'g') END AS id FROM c),
    f AS (SELECT doc_id, arg_min(id, cell_ord) AS id FROM i WHERE id IS NOT NULL GROUP BY doc_id)
    SELECT t.doc_id, CASE WHEN coalesce(cap, '') <> '' THEN regexp_extract(cap, '^Table ([0-9]+)', 1) ELSE coalesce(f.id, regexp_extract(prev, '^Table ([0-9]+)', 1)) END AS identifier FROM t LEFT JOIN f USING (doc_id)""")
def table_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    rows = V.table(spark, sf_dir, "documents").select("doc_id", F.lit(1).alias("page"), F.lit(0).alias("table_ord"))
    cap = F.when(d % 4 == 0, F.concat(F.lit("Table "), (d % 9).cast("string"), F.lit(" x"))).when(d % 4 == 1, F.lit(""))
    tables = rows.withColumns({"caption": cap, "prev_text": F.when(d % 3 == 0, "Table 77 before")})
    first = F.when(d % 5 < 3, "").otherwise(F.concat(F.lit(" cell: "), (d % 13).cast("string"), F.lit("/a ")))
    cells = rows.select("doc_id", "page", "table_ord", F.posexplode(F.array(first, F.lit("Table 5"))).alias("cell_ord", "text"))
    return assets.table_names(tables, cells).select("doc_id", "identifier")


def _legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = V.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"))
    x0, y0 = F.expr("cast((k * 37) % 300 as double)"), F.expr("cast((k * 53) % 400 as double)")
    size = F.expr("cast(if(k % 4 = 0, 250, 40 + k % 60) as double)")
    kind = F.expr("case k % 4 when 0 then 'image' when 1 then 'paragraph' when 2 then 'list' else 'table' end")
    content = F.expr("case when k % 4 in (1, 2) and k % 3 = 0 then concat('Fig. ', k % 4 + 1, ' text') when k % 4 = 3 then null else concat('text ', k) end")
    return k.select(F.expr("k div 20").alias("doc_id"), F.expr("cast(k % 20 as int)").alias("pos"), kind.alias("type"), F.when(F.col("k") % 7 != 0, F.col("k") % 13).alias("id"), F.expr("cast((k div 10) % 2 + 1 as int)").alias("page"), F.array(x0, y0, x0 + size, y0 + size).alias("bbox"), content.alias("content"), F.expr("if(k % 4 = 0, concat('figures/', k % 3, '.png'), null)").alias("source"))


_LEG = """WITH leg AS (SELECT doc_id // 20 AS doc_id, CAST(doc_id % 20 AS INTEGER) AS pos, CASE doc_id % 4 WHEN 0 THEN 'image' WHEN 1 THEN 'paragraph' WHEN 2 THEN 'list' ELSE 'table' END AS type, CASE WHEN doc_id % 7 <> 0 THEN doc_id % 13 END AS id, CAST((doc_id // 10) % 2 + 1 AS INTEGER) AS page,
    CAST((doc_id * 37) % 300 AS DOUBLE) AS x0, CAST((doc_id * 53) % 400 AS DOUBLE) AS y0, CAST(CASE WHEN doc_id % 4 = 0 THEN 250 ELSE 40 + doc_id % 60 END AS DOUBLE) AS z,
    CASE WHEN doc_id % 4 IN (1, 2) AND doc_id % 3 = 0 THEN 'Fig. ' || (doc_id % 4 + 1) || ' text' WHEN doc_id % 4 = 3 THEN NULL ELSE 'text ' || doc_id END AS content, CASE WHEN doc_id % 4 = 0 THEN 'figures/' || (doc_id % 3) || '.png' END AS source FROM documents),
    inside AS (SELECT DISTINCT t.doc_id, t.pos FROM leg t JOIN leg i ON i.doc_id = t.doc_id AND i.page = t.page AND i.type = 'image' WHERE t.type IN ('paragraph', 'list')
        AND least(t.x0 + t.z, i.x0 + i.z) > greatest(t.x0, i.x0) AND least(t.y0 + t.z, i.y0 + i.z) > greatest(t.y0, i.y0) AND (least(t.x0 + t.z, i.x0 + i.z) - greatest(t.x0, i.x0)) * (least(t.y0 + t.z, i.y0 + i.z) - greatest(t.y0, i.y0)) >= 0.75 * t.z * t.z)"""


@register(f"{_LEG} SELECT doc_id, pos, type, content FROM leg ANTI JOIN inside USING (doc_id, pos)")
def contained_text_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy.drop_contained(_legacy(spark, sf_dir)).select("doc_id", "pos", "type", "content")


_ORDERED = """, {0} fg AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source ORDER BY coalesce(id, 0), pos) AS n FROM src WHERE type = 'image' AND contains(coalesce(source, ''), 'figures/')),
    uq AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(id, 0), pos) AS number FROM fg WHERE n = 1),
    cp AS (SELECT doc_id, pos AS cap_pos, TRY_CAST(nullif(regexp_extract(coalesce(content, ''), '^\\s*(?:Figure|Fig\\.?)\\s*([0-9]+)', 1, 'i'), '') AS INTEGER) AS number FROM src WHERE type IN ('paragraph', 'list')),
    mv AS (SELECT uq.*, cp.cap_pos FROM uq JOIN cp USING (doc_id, number)), gone AS (SELECT doc_id, pos FROM fg WHERE n > 1 UNION SELECT doc_id, pos FROM mv),
    al AS (SELECT doc_id, pos AS old, pos AS at0, 1 AS side, type, source FROM src ANTI JOIN gone USING (doc_id, pos) UNION ALL SELECT doc_id, pos, cap_pos, 0, type, source FROM mv)
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY at0, side, old) - 1 AS INTEGER) AS pos, type, source FROM al"""


@register(_LEG + _ORDERED.format("src AS (SELECT * FROM leg),"))
def figure_reorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy.reorder_figures(_legacy(spark, sf_dir)).select("doc_id", "pos", "type", "source")


@register(_LEG + _ORDERED.format("""src AS (SELECT doc_id, pos, CASE WHEN type = 'table' AND id IS NOT NULL THEN 'image' ELSE type END AS type, id, page, content, CASE WHEN type = 'table' AND id IS NOT NULL THEN 'figures/table_' || id || '.png' ELSE source END AS source FROM leg ANTI JOIN inside USING (doc_id, pos)),"""))
def legacy_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _legacy(spark, sf_dir)
    heights = rows.select("doc_id", "page").distinct().withColumn("page_height", F.lit(800.0))
    return legacy.clean_legacy(rows, heights).select("doc_id", "pos", "type", "source")


_CROP = {"l": "CAST((k * 37) % 500 AS DOUBLE)", "w": "CAST(CASE WHEN k % 5 = 0 THEN 500 ELSE 120 END AS DOUBLE)", "t": "CAST(100 + (k * 91) % 600 AS DOUBLE)"}


def _chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = V.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"))

    def bbox(shift: int):
        e = {n: F.expr(x.replace("k", f"(k + {shift})").replace("DOUBLE", "double")) for n, x in _CROP.items()}
        return F.struct(e["l"].alias("l"), e["t"].alias("t"), (e["l"] + e["w"]).alias("r"), (e["t"] - 15).alias("b"))

    return k.select(F.col("k").alias("doc_id"), F.lit("s").alias("section"), F.lit(600.0).alias("page_w"), F.lit(800.0).alias("page_h"), F.expr("cast(k % 5 + 1 as int)").alias("start_page"), bbox(0).alias("start_bbox"), F.expr("cast(k % 5 + 1 + (k div 7) % 4 - if(k % 17 = 0, 2, 0) as int)").alias("end_page"), F.when(F.col("k") % 19 != 0, bbox(3)).alias("end_bbox"))


def _crop_sql() -> str:
    def cols(s: str, shift: int) -> str:
        return ", ".join(f"{x.replace('k', f'(k + {shift})')} AS {s}{n}" for n, x in _CROP.items())

    kind = lambda s: f"CASE WHEN {s}w < 0.65 * 600 THEN CASE WHEN {s}l + {s}w / 2 < 300 THEN 'left' ELSE 'right' END ELSE 'full' END"
    r = lambda *xs: "[" + ", ".join("[" + ", ".join(f"CAST({v} AS DOUBLE)" for v in x) + "]" for x in xs) + "]"
    ys, ye = "greatest(0.0, 800 - st)", "least(800.0, 800 - et)"
    both = {("full", "full"): r((0, ys, 600, ye)), ("left", "left"): r((0, ys, 300, ye)), ("left", "right"): r((0, ys, 300, 800), (300, 0, 600, ye)), ("right", "right"): r((300, ys, 600, ye)), ("right", "left"): r((300, ys, 600, 800)), ("left", "full"): r((0, ys, 300, ye), (300, 0, 600, ye)), ("right", "full"): r((300, ys, 600, ye)), ("full", "left"): r((0, ys, 300, ye)), ("full", "right"): r((0, ys, 300, 800), (300, ys, 600, ye))}
    first = {"full": r((0, ys, 600, 800)), "left": r((0, ys, 300, 800), (300, 0, 600, 800)), "right": r((300, ys, 600, 800))}
    last = {"full": r((0, 0, 600, ye)), "left": r((0, 0, 300, ye)), "right": r((0, 0, 300, 800), (300, 0, 600, ye))}
    case = "CASE " + " ".join(f"WHEN p = sp AND p = ep AND sk = '{a}' AND ek = '{b}' THEN {x}" for (a, b), x in both.items()) + " " + " ".join(f"WHEN p = sp AND p < ep AND sk = '{a}' THEN {x}" for a, x in first.items()) + " " + " ".join(f"WHEN p = ep AND p > sp AND ek = '{a}' THEN {x}" for a, x in last.items()) + f" ELSE {r((0, 0, 600, 800))} END"
    return f"""WITH c AS (SELECT k, CAST(k % 5 + 1 AS INTEGER) AS sp, CAST(k % 5 + 1 + (k // 7) % 4 - CASE WHEN k % 17 = 0 THEN 2 ELSE 0 END AS INTEGER) AS ep, k % 19 = 0 AS miss, {cols('s', 0)}, {cols('e', 3)} FROM (SELECT doc_id AS k FROM documents)),
        d AS (SELECT *, {kind('s')} AS sk, {kind('e')} AS ek FROM c), g AS (SELECT *, unnest(range(sp, ep + 1)) AS p FROM d WHERE NOT miss AND ep >= sp), h AS (SELECT k, p, {case} AS rs FROM g),
        u AS (SELECT k, p, unnest(rs) AS rr, unnest(range(1, len(rs) + 1)) AS i FROM h)
        SELECT k AS doc_id, CAST(row_number() OVER (PARTITION BY k ORDER BY p, i) - 1 AS INTEGER) AS out_ord, CAST(p AS INTEGER) AS src_page, rr[1] AS x0, rr[2] AS y0, rr[3] AS x1, rr[4] AS y1, CAST(NULL AS VARCHAR) AS error FROM u
        UNION ALL SELECT k, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN miss THEN 'missing page or box' ELSE 'end before start' END FROM d WHERE miss OR ep < sp"""


@register(_crop_sql())
def crop_rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cropping.crop_plan(_chapters(spark, sf_dir)).select("doc_id", "out_ord", "src_page", "rect.x0", "rect.y0", "rect.x1", "rect.y1", "error")


_CHUNKS = f"""WITH RECURSIVE {V.SQL_TALK}, sums AS (SELECT *, sum(tok) OVER (PARTITION BY doc_id ORDER BY pos) AS c, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) IS NULL AS last FROM talk),
    look AS (SELECT s.*, coalesce((SELECT min(x.c) FROM sums x WHERE x.doc_id = s.doc_id AND x.pos > s.pos AND x.type <> 'heading'), (SELECT max(x.c) FROM sums x WHERE x.doc_id = s.doc_id)) - s.c + s.tok AS look FROM sums s),
    seq AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM look WHERE type NOT IN ('html', 'figure', 'table')),
    fold AS (SELECT doc_id, 0::BIGINT AS i, 0::BIGINT AS cur, 0 AS chunk_no, -1 AS pos FROM (SELECT DISTINCT doc_id FROM seq)
        UNION ALL SELECT doc_id, i, CASE WHEN full_ THEN 0 ELSE cur END + tok, chunk_no + CASE WHEN full_ THEN 1 ELSE 0 END, pos
        FROM (SELECT q.doc_id, q.i, q.tok, q.pos, f.cur, f.chunk_no, f.i > 0 AND CASE WHEN q.type = 'heading' AND NOT q.last THEN f.cur + q.look >= 110 ELSE f.cur + q.tok > 110 END AS full_ FROM fold f JOIN seq q ON q.doc_id = f.doc_id AND q.i = f.i + 1)),
    ch AS (SELECT f.doc_id, f.pos, f.chunk_no, q.type, q.level, q.content FROM fold f JOIN seq q ON q.doc_id = f.doc_id AND q.i = f.i WHERE f.i > 0)"""
_PREFIX = """, st AS (SELECT doc_id, chunk_no, min(pos) AS first, arg_min(CASE WHEN type = 'heading' THEN level END, pos) AS fl FROM ch GROUP BY ALL),
    pre AS (SELECT st.doc_id, st.chunk_no, h.pos, h.type, h.content FROM st JOIN ch h ON h.doc_id = st.doc_id AND h.type = 'heading' AND h.pos < st.first
        WHERE h.level < least(coalesce((SELECT min(k.level) FROM ch k WHERE k.doc_id = st.doc_id AND k.type = 'heading' AND k.pos > h.pos AND k.pos < st.first), 1000), coalesce(st.fl, 1000)))"""


@register(f"{_CHUNKS} SELECT doc_id, pos, chunk_no FROM ch")
def chunk_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.assign_chunks(V.talk(spark, sf_dir), 100, 0.1).select("doc_id", "pos", "chunk_no")


@register(f"{_CHUNKS}{_PREFIX} SELECT doc_id, chunk_no, pos FROM pre")
def chunk_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.talk(spark, sf_dir)
    return chunking.chunk_prefixes(rows, chunking.assign_chunks(rows, 100, 0.1)).select("doc_id", "chunk_no", "pos")


@register(f"""{_CHUNKS}{_PREFIX}, body AS (SELECT *, row_number() OVER (PARTITION BY doc_id, chunk_no ORDER BY pos) AS i, last_value(CASE WHEN type <> 'list' THEN pos END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS op FROM ch),
    pi AS (SELECT *, row_number() OVER (PARTITION BY doc_id, chunk_no ORDER BY pos) AS i FROM pre), pk AS (SELECT pi.* FROM pi LEFT JOIN body b USING (doc_id, chunk_no, i) WHERE NOT coalesce(b.type = pi.type AND b.content = pi.content, false)),
    en AS (SELECT doc_id, chunk_no, arg_max(op, pos) AS op, arg_min(type, pos) AS ht, arg_min(content, pos) AS hc FROM body GROUP BY ALL),
    ca AS (SELECT en.doc_id, en.chunk_no, en.op AS pos FROM en JOIN ch o ON o.doc_id = en.doc_id AND o.pos = en.op WHERE ht = 'list' AND o.content <> hc AND NOT EXISTS (SELECT 1 FROM pk WHERE pk.doc_id = en.doc_id AND pk.chunk_no = en.chunk_no)),
    un AS (SELECT doc_id, chunk_no, 'prefix' AS role, pos, 0 AS r FROM pk UNION ALL SELECT doc_id, chunk_no, 'carry', pos, 1 FROM ca UNION ALL SELECT doc_id, chunk_no, 'body', pos, 2 FROM body)
    SELECT doc_id, chunk_no, CAST(row_number() OVER (PARTITION BY doc_id, chunk_no ORDER BY r, pos) - 1 AS INTEGER) AS ord, role, pos FROM un""")
def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.build_chunks(V.talk(spark, sf_dir), 100, 0.1).select("doc_id", "chunk_no", "ord", "role", "pos")


@register("""SELECT conv_id AS doc_id, turn AS pos, CAST(CASE WHEN turn % 3 = 0 THEN CASE WHEN turn % 2 = 0 THEN 7 ELSE 0 END WHEN turn % 3 = 1 THEN 9 ELSE 0 END AS INTEGER) AS tok, role IN ('list', 'list_item') OR turn % 4 = 1 AS is_list FROM conversations""")
def token_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("turn")
    own = F.when(t % 3 == 0, F.when(t % 2 == 0, F.create_map(F.lit("m"), F.lit(7))).otherwise(F.create_map(F.lit("other"), F.lit(3))))
    meta = F.when(t % 3 == 1, F.create_map(F.lit("m"), F.lit(9)))
    style = F.when(t % 4 == 1, chunking.LIST_STYLE)
    return V.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), t.alias("pos"), chunking.block_tokens(own, meta, "m").alias("tok"), chunking.is_list(F.col("role"), style).alias("is_list"))
