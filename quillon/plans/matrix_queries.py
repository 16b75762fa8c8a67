"""Queries over sparse matrices and fits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contacts, matrix, models
from ..operators.quantiles import percentiles
from ..sources.tables import stored
from .inputs import SQL_E, SQL_V, contigs, edges, table
from .registry import query


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns or ("v",)})


@query("symmetrize", f"with {SQL_E} select i, j, v from full_e")
def symmetrize(spark, sf):
    return contacts.symmetric(edges(spark, sf))


@query("zero_diagonal", f"with {SQL_E} select i, j, v from e where i <> j")
def zero_diagonal(spark, sf):
    return contacts.off_diagonal(edges(spark, sf))


@query("norm_sites", f"""with {SQL_E}, {SQL_V} select i, j, round(v / (greatest(1, a.sites) * greatest(1, b.sites)), 6) v from e join vert a on a.contig = i join vert b on b.contig = j""")
def norm_sites(spark, sf):
    return rounded(matrix.site_normalised(edges(spark, sf), contigs(spark, sf)))


for _mean, _sql in (("geometric", "sqrt(a.length * b.length)"), ("harmonic", "2.0 * a.length * b.length / (a.length + b.length)"), ("arithmetic", "(a.length + b.length) / 2.0")):

    @query(f"norm_length_{_mean}", f"""with {SQL_E}, {SQL_V} select i, j, round(v / (1e-3 * {_sql}), 6) v from e join vert a on a.contig = i join vert b on b.contig = j""")
    def norm_length(spark, sf, mean=_mean):
        return rounded(matrix.length_normalised(edges(spark, sf), contigs(spark, sf), mean))


@query("norm_coverage", f"""with {SQL_E}, {SQL_V} select i, j, round(v / sqrt((a.coverage + 1e-9) * (b.coverage + 1e-9)), 6) v from e join vert a on a.contig = i join vert b on b.contig = j where i <> j""")
def norm_coverage(spark, sf):
    return rounded(matrix.coverage_normalised(edges(spark, sf), contigs(spark, sf)))


@query("norm_regression_fixed", f"""with {SQL_E}, {SQL_V}, mu as (select contig, exp(0.3 * ln(sites + 1) + 0.2 * ln(length)) mu from vert)
select i, j, round((select max(mu) from mu) * v / sqrt(a.mu * b.mu), 6) v from e join mu a on a.contig = i join mu b on b.contig = j where i <> j""")
def norm_regression_fixed(spark, sf):
    return rounded(matrix.regression_scaled(edges(spark, sf), contigs(spark, sf), F.expr("exp(0.3 * ln(sites + 1) + 0.2 * ln(length))")))


@query("denoise_percentile", f"with {SQL_E} select i, j, v from e where v > (select quantile_cont(v, 0.05) from e)")
def denoise_percentile(spark, sf):
    return matrix.above_percentile(edges(spark, sf), 5)


@query("percentile_prices", "select round(quantile_cont(l_extendedprice, 0.05), 6) p5, round(quantile_cont(l_extendedprice, 0.8), 6) p80 from lineitem")
def percentile_prices(spark, sf):
    p5, p80 = percentiles(table(spark, sf, "lineitem"), "l_extendedprice", [0.05, 0.8])
    return spark.createDataFrame([(p5, p80)], "p5 double, p80 double").select(F.round("p5", 6).alias("p5"), F.round("p80", 6).alias("p80"))


@query("max_scaled", f"with {SQL_E} select i, j, round(v / (select max(v) from e), 6) v from e")
def max_scaled(spark, sf):
    return rounded(matrix.max_scaled(edges(spark, sf)))


@query("compress_submatrix", f"""with {SQL_E}, k as (select s_suppkey contig, row_number() over (order by s_suppkey) - 1 place from supplier where abs(s_acctbal) >= 3000)
select a.place i, b.place j, v from e join k a on a.contig = i join k b on b.contig = j""")
def compress_submatrix(spark, sf):
    return matrix.compressed(edges(spark, sf), contigs(spark, sf).where("coverage >= 30"))


@query("permute_matrix", f"""with {SQL_E}, k as (select s_suppkey contig, row_number() over (order by s_name desc) - 1 place from supplier)
select least(a.place, b.place) i, greatest(a.place, b.place) j, v from e join k a on a.contig = i join k b on b.contig = j""")
def permute_matrix(spark, sf):
    from ..operators.ordering import dense_numbers

    up = dense_numbers(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("contig"), "s_name"), "s_name", "up")
    n = up.agg(F.count("*").alias("n"))
    return matrix.permuted(edges(spark, sf), up.crossJoin(F.broadcast(n)).select("contig", (F.col("n") - 1 - F.col("up")).alias("place")))


@query("block_downsample", f"with {SQL_E} select i // 10 i, j // 10 j, round(sum(v) / 100, 6) v from e group by 1, 2")
def block_downsample(spark, sf):
    return rounded(matrix.downsampled(edges(spark, sf), 10))


@query("block_maximum", f"with {SQL_E} select i // 10 i, j // 10 j, max(v) v from e group by 1, 2")
def block_maximum(spark, sf):
    return matrix.downsampled(edges(spark, sf), 10, "max")


@query("matrix_product", f"with {SQL_E} select a.i, b.j, cast(sum(a.v * b.v) as bigint) v from full_e a join full_e b on a.j = b.i group by 1, 2")
def matrix_product(spark, sf):
    full = contacts.symmetric(stored(edges(spark, sf)))  # both sides are of one pairing
    return matrix.product(full, full)


SQL_ST = """, off as (select i, j, cast(v as double) v from full_e where i <> j union all select s_suppkey, s_suppkey, 1.0 from supplier where s_suppkey not in (select j from full_e where i <> j)),
st as (select i, off.j, v / s v from off join (select j, sum(v) s from off group by 1) t on t.j = off.j)"""


@query("column_stochastic", f"with {SQL_E} {SQL_ST} select i, j, round(v, 6) v from st")
def column_stochastic(spark, sf):
    return rounded(matrix.column_stochastic(contacts.symmetric(edges(spark, sf)), contigs(spark, sf).select("contig")))


@query("restart_walk_2", f"""with {SQL_E} {SQL_ST}, u as (select s_suppkey i, s_suppkey j, 1.0 v from supplier where abs(s_acctbal) >= 9500),
q1 as (select i, j, sum(v) v from (select u.i, st.j, 0.5 * u.v * st.v v from u join st on u.j = st.i union all select i, j, 0.5 * v from u) group by 1, 2),
q2 as (select i, j, sum(v) v from (select q1.i, st.j, 0.5 * q1.v * st.v v from q1 join st on q1.j = st.i union all select i, j, 0.5 * v from u) group by 1, 2)
select i, j, round(v, 6) v from q2""")
def restart_walk_2(spark, sf):
    p = matrix.column_stochastic(contacts.symmetric(stored(edges(spark, sf))), contigs(spark, sf).select("contig"))
    return rounded(matrix.walked(p, contigs(spark, sf).where("coverage >= 95"), 0.5, 2, tolerance=0.0))


@query("degree_normalised", f"""with {SQL_E}, b as (select i, j, sum(v) v from (select i, j, v from full_e union all select j, i, v from full_e) group by 1, 2), d as (select i k, sum(v) d from b group by 1)
select b.i, b.j, round(v / sqrt(x.d * y.d), 6) v from b join d x on x.k = b.i join d y on y.k = b.j""")
def degree_normalised(spark, sf):
    return rounded(matrix.degree_normalised(contacts.symmetric(edges(spark, sf))))


SQL_B = """, ids as (select distinct i k from full_e), w as (select i, j, cast(v as double) v from full_e union all select k, k, 1.0 from ids where k not in (select i from e where i = j)), x0 as (select k, cast(1.0 as double) x from ids),
x1 as (select x0.k, sqrt(any_value(x0.x) / sum(w.v * y.x)) x from x0 join w on w.i = x0.k join x0 y on y.k = w.j group by 1),
x2 as (select x1.k, sqrt(any_value(x1.x) / sum(w.v * y.x)) x from x1 join w on w.i = x1.k join x1 y on y.k = w.j group by 1),
x3 as (select x2.k, sqrt(any_value(x2.x) / sum(w.v * y.x)) x from x2 join w on w.i = x2.k join x2 y on y.k = w.j group by 1)"""


@query("balance_3", f"with {SQL_E} {SQL_B} select i, j, round(a.x * v * b.x, 6) v from e join x3 a on a.k = i join x3 b on b.k = j")
def balance_3(spark, sf):
    return rounded(matrix.balanced(edges(spark, sf), 3)[1])


@query("matrix_sparsity", f"with {SQL_E} select round(count(*) / ((select count(*) from supplier) * (select count(*) from supplier)), 6) sparsity from full_e")
def matrix_sparsity(spark, sf):
    return rounded(matrix.sparsity(contacts.symmetric(edges(spark, sf)), contigs(spark, sf)), "sparsity")


SQL_T = "t as (select l_suppkey i, l_partkey % 50 j, l_linenumber % 2 k, cast(l_quantity as int) % 2 l, count(*) v from lineitem group by 1, 2, 3, 4)"


def tensor(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("i"), (F.col("l_partkey") % 50).alias("j"), (F.col("l_linenumber") % 2).alias("k"), (F.col("l_quantity").cast("int") % 2).alias("l")).agg(F.count("*").alias("v"))


@query("tensor_marginal", f"with {SQL_T} select i, j, cast(sum(v) as bigint) v from t group by 1, 2")
def tensor_marginal(spark, sf):
    return matrix.marginal(tensor(spark, sf))


@query("tensor_flattened", f"with {SQL_T} select 2 * i + k i, 2 * j + l j, v from t")
def tensor_flattened(spark, sf):
    return matrix.flattened(tensor(spark, sf))


@query("topk_neighbors", f"""with {SQL_E} select i, j, v, rank from (select i, j, v, row_number() over (partition by i order by v desc, j) rank from full_e where i <> j) where rank <= 5""")
def topk_neighbors(spark, sf):
    return matrix.neighbours(contacts.symmetric(edges(spark, sf)), 5).withColumn("rank", F.col("rank").cast("long"))


@query("neighbourhood_fold", f"""with {SQL_E}, {SQL_V}, k as (select i, j from (select i, j, row_number() over (partition by i order by v desc, j) r from full_e where i <> j) where r <= 5)
select i contig, round(a.coverage / exp(avg(ln(b.coverage + 1e-9))), 4) fold from k join vert a on a.contig = i join vert b on b.contig = j group by i, a.coverage""")
def neighbourhood_fold(spark, sf):
    k = matrix.neighbours(contacts.symmetric(edges(spark, sf)), 5)
    b = matrix.with_attributes(k.select("i", "j"), contigs(spark, sf), "coverage")
    return b.groupBy(F.col("i").alias("contig"), "coverage_i").agg(F.exp(F.avg(F.log(F.col("coverage_j") + 1e-9))).alias("near")).select("contig", F.round(F.col("coverage_i") / F.col("near"), 4).alias("fold"))


@query("heatmap_intensity", f"with {SQL_E} select i, j, round(ln(v + 0.01), 6) v from full_e")
def heatmap_intensity(spark, sf):
    return contacts.symmetric(edges(spark, sf)).select("i", "j", F.round(F.log(F.col("v") + 0.01), 6).alias("v"))


@query("gaussian_em")
def gaussian_em(spark, sf):
    got = models.gaussian_mixture(table(spark, sf, "events"), "value")
    return spark.createDataFrame([tuple(got.values())], ", ".join(f"{k} double" for k in got))
