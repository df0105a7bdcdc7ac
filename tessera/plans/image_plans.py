"""Image-set plans
over ``IMG`` (embeddings as 8x8 one-channel images, 10 classes)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tessera.functions.exprs import EPSILON_CLIP, argmax, clip, correct_flag
from tessera.operators import images as IM
from tessera.operators.lookups import join_dimension
from tessera.plans import standins as SI
from tessera.plans.registry import plan

H, W, K = SI.IMG_H, SI.IMG_W, SI.IMG_CLASSES
N_PX = H * W

# Class names of the image set, index = class id.
CLASS_NAMES = ["T-shirt", "Pantalon", "Pull", "Robe", "Manteau",
               "Sandale", "Chemise", "Sneaker", "Sac", "Bottine"]


# Stored layer parameters, generated from a rule (not tabulated).
def _r6(x):
    return round(x, 6)


DENSE_W = [[_r6(0.5 * math.sin(0.37 * i + 1.3 * j + 0.1)) for i in range(N_PX)] for j in range(K)]
DENSE_B = [_r6(0.05 * (j - 4.5)) for j in range(K)]
KERNELS = [[[_r6(0.3 * math.cos(f * 9 + dy * 3 + dx)) for dx in range(3)] for dy in range(3)]
           for f in range(2)]
KERNEL_BIAS = [0.01, -0.02]
BN_MEAN = [_r6(0.01 * math.sin(i)) for i in range(N_PX)]
BN_VAR = [_r6(0.5 + 0.25 * math.cos(i)) for i in range(N_PX)]
BN_GAMMA = [_r6(1.0 + 0.1 * math.sin(2 * i)) for i in range(N_PX)]
BN_BETA = [_r6(0.05 * math.cos(3 * i)) for i in range(N_PX)]


def _dbl(values):
    return "(CAST([" + ", ".join(repr(float(v)) for v in values) + "] AS DOUBLE[]))"


def _dbl2(rows):
    inner = ", ".join("[" + ", ".join(repr(float(v)) for v in r) + "]" for r in rows)
    return "(CAST([" + inner + "] AS DOUBLE[][]))"


def round_arr(col, d=6):
    return F.transform(col, lambda v: F.round(v, d))


def _img(spark, sf_dir):
    return SI.images(spark, sf_dir)


def logits(spark, sf_dir):
    img = _img(spark, sf_dir)
    return img.select("id", "label", IM.dense(F.col("px"), DENSE_W, DENSE_B).alias("z"))


_LOGITS_SQL = f"""zz AS (SELECT id, label, list_transform(range(0, {K}),
    lambda j: {_dbl(DENSE_B)}[j + 1] + list_dot_product(CAST(px AS DOUBLE[]), {_dbl2(DENSE_W)}[j + 1])) AS z
  FROM IMG)"""
_SOFTMAX_SQL = """sm AS (SELECT id, label, z,
    list_transform(list_transform(z, lambda v: exp(v - list_max(z))),
                   lambda e: e) AS e FROM zz),
pr AS (SELECT id, label, z, list_transform(e, lambda v: v / list_sum(e)) AS probs FROM sm)"""


@plan("img_normalize", uses=("IMG",), sql="""
SELECT id, list_transform(px, lambda v: CAST(v AS DOUBLE) / 255.0) AS px FROM IMG""")
def img_normalize(spark, sf_dir):
    return _img(spark, sf_dir).select("id", IM.normalize(F.col("px")).alias("px"))


@plan("img_reshape", uses=("IMG",), sql=f"""
SELECT id, list_transform(range(0, {H}), lambda r: px[r * {W} + 1 : r * {W} + {W}]) AS rows FROM IMG""")
def img_reshape(spark, sf_dir):
    return _img(spark, sf_dir).select("id", IM.reshape(F.col("px"), H, W).alias("rows"))


@plan("img_flatten", uses=("IMG",), sql=f"""
SELECT id, flatten(list_transform(range(0, {H}), lambda r: px[r * {W} + 1 : r * {W} + {W}])) AS px FROM IMG""")
def img_flatten(spark, sf_dir):
    return _img(spark, sf_dir).select("id", IM.flatten(IM.reshape(F.col("px"), H, W)).alias("px"))


@plan("img_label_onehot", uses=("IMG",), sql=f"""
SELECT id, list_transform(range(0, {K}), lambda i: CASE WHEN i = label THEN 1 ELSE 0 END) AS onehot FROM IMG""")
def img_label_onehot(spark, sf_dir):
    return _img(spark, sf_dir).select("id", IM.label_onehot(F.col("label"), K).alias("onehot"))


_NAMES_VALUES = ", ".join(f"({i}, '{n}')" for i, n in enumerate(CLASS_NAMES))


def class_names(spark):
    return spark.createDataFrame(list(enumerate(CLASS_NAMES)), "label int, name string")


@plan("join_class_name", uses=("IMG",), sql=f"""
SELECT id, IMG.label, name FROM IMG JOIN (VALUES {_NAMES_VALUES}) n(label, name) ON IMG.label = n.label""")
def join_class_name(spark, sf_dir):
    img = _img(spark, sf_dir).select("id", "label")
    return join_dimension(img, class_names(spark), "label").select("id", "label", "name")


@plan("score_dense_forward", uses=("IMG",), sql=f"""
WITH {_LOGITS_SQL} SELECT id, list_transform(z, lambda v: ROUND(v, 6)) AS z FROM zz""")
def score_dense_forward(spark, sf_dir):
    return logits(spark, sf_dir).select("id", round_arr(F.col("z")).alias("z"))


@plan("expr_activations", uses=("IMG",), sql=f"""
WITH {_LOGITS_SQL}, {_SOFTMAX_SQL}
SELECT id, list_transform(z, lambda v: ROUND(GREATEST(v, 0.0), 6)) AS relu,
       list_transform(z, lambda v: ROUND(1.0 / (1.0 + exp(-v)), 6)) AS sigmoid,
       list_transform(z, lambda v: ROUND(tanh(v), 6)) AS tanh,
       list_transform(probs, lambda v: ROUND(v, 6)) AS softmax FROM pr""")
def expr_activations(spark, sf_dir):
    z = F.col("z")
    return logits(spark, sf_dir).select(
        "id", *[round_arr(IM.activate(z, a)).alias(a) for a in ("relu", "sigmoid", "tanh", "softmax")])


@plan("expr_argmax", uses=("IMG",), sql=f"""
WITH {_LOGITS_SQL}, {_SOFTMAX_SQL}
SELECT id, CAST(list_position(probs, list_max(probs)) - 1 AS INT) AS pred FROM pr""")
def expr_argmax(spark, sf_dir):
    return logits(spark, sf_dir).select("id", argmax(IM.activate(F.col("z"), "softmax")).alias("pred"))


@plan("eval_logloss_multi", uses=("IMG",), sql=f"""
WITH {_LOGITS_SQL}, {_SOFTMAX_SQL}
SELECT ROUND(-AVG(LN(LEAST(GREATEST(probs[label + 1], {EPSILON_CLIP}), 1 - {EPSILON_CLIP}))), 6) AS logloss FROM pr""")
def eval_logloss_multi(spark, sf_dir):
    pr = logits(spark, sf_dir).select("label", IM.activate(F.col("z"), "softmax").alias("probs"))
    p = clip(F.element_at("probs", F.col("label") + 1))
    return pr.agg(F.round(-F.avg(F.ln(p)), 6).alias("logloss"))


@plan("eval_accuracy_multi", uses=("IMG",), sql=f"""
WITH {_LOGITS_SQL}, {_SOFTMAX_SQL}
SELECT ROUND(AVG(CAST(list_position(probs, list_max(probs)) - 1 = label AS DOUBLE)), 6) AS accuracy FROM pr""")
def eval_accuracy_multi(spark, sf_dir):
    pr = logits(spark, sf_dir).select("label", argmax(IM.activate(F.col("z"), "softmax")).alias("pred"))
    return pr.agg(F.round(F.avg((F.col("pred") == F.col("label")).cast("double")), 6).alias("accuracy"))


@plan("eval_prediction_review", uses=("IMG",), sql=f"""
WITH {_LOGITS_SQL}, {_SOFTMAX_SQL},
n AS (SELECT * FROM (VALUES {_NAMES_VALUES}) n(label, name)),
pd AS (SELECT id, label, CAST(list_position(probs, list_max(probs)) - 1 AS INT) AS pred FROM pr ORDER BY id LIMIT 16)
SELECT pd.id, pn.name AS predicted, tn.name AS actual,
       CASE WHEN pd.pred = pd.label THEN 'green' ELSE 'red' END AS flag
FROM pd JOIN n pn ON pd.pred = pn.label JOIN n tn ON pd.label = tn.label""")
def eval_prediction_review(spark, sf_dir):
    pr = logits(spark, sf_dir).select(
        "id", "label", argmax(IM.activate(F.col("z"), "softmax")).alias("pred"))
    first = pr.orderBy("id").limit(16)
    names = class_names(spark)
    pn = names.select(F.col("label").alias("pred"), F.col("name").alias("predicted"))
    tn = names.select("label", F.col("name").alias("actual"))
    j = join_dimension(join_dimension(first, pn, "pred"), tn, "label")
    return j.select("id", "predicted", "actual",
                    correct_flag(F.col("pred"), F.col("label")).alias("flag"))


@plan("score_batchnorm", uses=("IMG",), sql=f"""
SELECT id, list_transform(range(0, {N_PX}), lambda i:
    ROUND((CAST(px[i + 1] AS DOUBLE) - {_dbl(BN_MEAN)}[i + 1]) / SQRT({_dbl(BN_VAR)}[i + 1] + 0.001)
          * {_dbl(BN_GAMMA)}[i + 1] + {_dbl(BN_BETA)}[i + 1], 6)) AS px FROM IMG""")
def score_batchnorm(spark, sf_dir):
    bn = IM.batchnorm(F.col("px"), BN_MEAN, BN_VAR, BN_GAMMA, BN_BETA)
    return _img(spark, sf_dir).select("id", round_arr(bn).alias("px"))


def _conv_ctes(padding):
    """Relational convolution (oracle side): pixels unnested with their index,
    joined to the kernel offsets, summed per output cell -> CTE ``convc``."""
    k = 3
    pad = (k - 1) // 2 if padding == "same" else 0
    ho, wo = (H, W) if padding == "same" else (H - k + 1, W - k + 1)
    kv = ", ".join(f"({f}, {dy}, {dx}, {KERNELS[f][dy][dx]!r})"
                   for f in range(len(KERNELS)) for dy in range(k) for dx in range(k))
    bv = ", ".join(f"({f}, {b!r})" for f, b in enumerate(KERNEL_BIAS))
    return f"""pxl AS (SELECT id, CAST(generate_subscripts(px, 1) - 1 AS INT) AS i, CAST(unnest(px) AS DOUBLE) AS v FROM IMG),
pc AS (SELECT id, i // {W} AS r, i % {W} AS c, v FROM pxl),
kt AS (SELECT * FROM (VALUES {kv}) t(f, dy, dx, w)),
bt AS (SELECT * FROM (VALUES {bv}) t(f, b)),
cells AS (SELECT id, f, r - dy + {pad} AS ro, c - dx + {pad} AS co, w * v AS t FROM pc, kt
          WHERE r - dy + {pad} BETWEEN 0 AND {ho - 1} AND c - dx + {pad} BETWEEN 0 AND {wo - 1}),
convc AS (SELECT id, CAST(cells.f AS INT) AS f, CAST(ro AS INT) AS r, CAST(co AS INT) AS c,
                 SUM(t) + MAX(b) AS value
          FROM cells JOIN bt ON cells.f = bt.f GROUP BY id, cells.f, ro, co)"""


def _conv_sql(padding):
    return f"WITH {_conv_ctes(padding)} SELECT id, f, r, c, ROUND(value, 6) AS value FROM convc"


def conv_cells(spark, sf_dir, padding):
    """Convolution of every image (NumPy fast path per Arrow batch), one row
    per output cell."""
    ho, wo = (H, W) if padding == "same" else (H - 2, W - 2)
    conv = IM.conv2d_pandas(_img(spark, sf_dir), "px", H, W, KERNELS, KERNEL_BIAS, padding, keep=["id"])
    e = conv.select("id", F.posexplode("out").alias("pos", "value"))
    f = (F.col("pos") / (ho * wo)).cast("int")
    rem = F.col("pos") - f * (ho * wo)
    return e.select("id", f.alias("f"), (rem / wo).cast("int").alias("r"),
                    (rem % wo).cast("int").alias("c"), F.round("value", 6).alias("value"))


@plan("img_conv2d_same", uses=("IMG",), sql=_conv_sql("same"))
def img_conv2d_same(spark, sf_dir):
    return conv_cells(spark, sf_dir, "same")


@plan("img_conv2d_valid", uses=("IMG",), sql=_conv_sql("valid"))
def img_conv2d_valid(spark, sf_dir):
    return conv_cells(spark, sf_dir, "valid")


def _pool_sql(kind):
    ho, wo = H // 2, W // 2

    def at(dy, dx):
        return f"CAST(px[(2 * (o // {wo}) + {dy}) * {W} + 2 * (o % {wo}) + {dx} + 1] AS DOUBLE)"

    vals = [at(dy, dx) for dy in range(2) for dx in range(2)]
    body = f"GREATEST({', '.join(vals)})" if kind == "max" else f"({' + '.join(vals)}) / 4.0"
    return f"SELECT id, list_transform(range(0, {ho * wo}), lambda o: ROUND({body}, 6)) AS pooled FROM IMG"


@plan("img_avg_pool", uses=("IMG",), sql=_pool_sql("avg"))
def img_avg_pool(spark, sf_dir):
    return _img(spark, sf_dir).select("id", round_arr(IM.pool2d(F.col("px"), H, W, "avg")).alias("pooled"))


@plan("img_max_pool", uses=("IMG",), sql=_pool_sql("max"))
def img_max_pool(spark, sf_dir):
    return _img(spark, sf_dir).select("id", round_arr(IM.pool2d(F.col("px"), H, W, "max")).alias("pooled"))


@plan("img_global_avg_pool", uses=("IMG",), sql="""
SELECT id, ROUND(list_sum(CAST(px AS DOUBLE[])) / len(px), 6) AS gap FROM IMG""")
def img_global_avg_pool(spark, sf_dir):
    return _img(spark, sf_dir).select("id", F.round(IM.global_avg_pool(F.col("px")), 6).alias("gap"))


@plan("img_residual_add", uses=("IMG",), sql=f"""
WITH {_conv_ctes("same")},
x AS (SELECT id, list(value ORDER BY r, c) AS xs FROM convc WHERE f = 0 GROUP BY id)
SELECT x.id, list_transform(range(0, {N_PX}),
         lambda i: ROUND(GREATEST(xs[i + 1] + CAST(px[i + 1] AS DOUBLE), 0.0), 6)) AS out
FROM x JOIN IMG ON x.id = IMG.id""")
def img_residual_add(spark, sf_dir):
    img = _img(spark, sf_dir)
    conv = IM.conv2d_pandas(img, "px", H, W, KERNELS[:1], KERNEL_BIAS[:1], "same", keep=["id", "px"])
    return conv.select("id", round_arr(IM.residual_add(F.col("out"), F.col("px"))).alias("out"))
