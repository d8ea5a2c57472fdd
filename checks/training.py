"""Training-set preparation queries with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.classes import source_image_id as source_id
from marketloom.operators import splits as Sp
from marketloom.sources import images as Im
from marketloom.sources import retail_star as star

from .sql import query, r, view

QUERIES, ORACLE = {}, {}


def register(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn

    return add


ROOT = "/data/fruit"

view(
    "paths",
    """SELECT doc_id, CASE WHEN doc_id % 101 = 0 THEN '/data/extra/' ELSE '/data/fruit/' END || lang || '/' ||
        CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'rotated_by_45_' WHEN 2 THEN 'vertical_flip_' ELSE 'Noise_' END || 'img' || (doc_id // 4) ||
        CASE WHEN doc_id % 6 = 0 THEN '_augmented_' || (doc_id % 5) ELSE '' END || CASE WHEN doc_id % 97 = 0 THEN '.txt' WHEN doc_id % 5 = 0 THEN '.JPG' ELSE '.jpg' END AS path FROM documents""",
)
view(
    "listing",
    """SELECT path AS image_path, substr(path, 13) AS relative_path, split_part(substr(path, 13), '/', 1) AS class_name FROM paths
        WHERE starts_with(path, '/data/fruit/') AND regexp_matches(path, '\\.(jpg|jpeg|png|JPG|JPEG|PNG)$')""",
    "paths",
)
SOURCE = (
    "split_part({p}, '/', 1) || '/' || regexp_replace(regexp_replace(regexp_replace(regexp_replace(split_part({p}, '/', 2), '^rotated_by_[0-9]+_', '', 'i'), '^vertical_flip_', '', 'i'), '^noise_', '', 'i'), '_augmented_[0-9]+\\.', '.', 'i')"
)
HASH = "md5('42|' || {k})"
view(
    "split_rows",
    f"""SELECT image_path, relative_path, class_name, CASE WHEN fr < 0.7::DOUBLE THEN 'train' WHEN fr < 0.7::DOUBLE + 0.15::DOUBLE THEN 'val' ELSE 'test' END AS split FROM
        (SELECT *, (row_number() OVER (PARTITION BY class_name ORDER BY {HASH.format(k='relative_path')}, relative_path) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY class_name) AS fr FROM listing)""",
    "listing",
)
view("sourced", f"SELECT *, {SOURCE.format(p='relative_path')} AS source_image_id FROM split_rows", "split_rows")
view("overlap", "SELECT source_image_id FROM sourced GROUP BY 1 HAVING count(DISTINCT split) > 1", "sourced")
view("counts", "SELECT class_name, count(*) AS n FROM listing GROUP BY 1", "listing")


def paths(spark: SparkSession, sf: str) -> DataFrame:
    return star.image_paths(spark, sf)


def listing(spark, sf) -> DataFrame:
    return Im.image_listing(paths(spark, sf), ROOT)


def split_rows(spark, sf) -> DataFrame:
    return Sp.stratified_split(listing(spark, sf), "relative_path")


@register("image_listing", query("SELECT * FROM listing", "listing"))
def image_listing(spark, sf):
    return listing(spark, sf)


@register("dataset_root_pick", query("""SELECT root, count(*) AS class_folders FROM (SELECT DISTINCT regexp_replace(path, '/[^/]*/[^/]*$', '') AS root, regexp_replace(path, '/[^/]*$', '') AS folder FROM paths
    WHERE regexp_matches(path, '\\.(jpg|jpeg|png|JPG|JPEG|PNG)$')) GROUP BY 1 ORDER BY count(*) = 4 DESC, 2 DESC, 1 LIMIT 1""", "paths"))
def dataset_root_pick(spark, sf):
    return Im.dataset_root_pick(paths(spark, sf), 4)


@register("source_image_id", query(f"SELECT relative_path, {SOURCE.format(p='relative_path')} AS source_image_id FROM listing", "listing"))
def source_image_id(spark, sf):
    return listing(spark, sf).select("relative_path", source_id(F.col("relative_path")).alias("source_image_id"))


@register("class_index", query("SELECT class_name, (row_number() OVER (ORDER BY class_name) - 1)::INTEGER AS class_index FROM counts", "counts"))
def class_index(spark, sf):
    return Sp.class_index(listing(spark, sf))


@register("class_balance", query(f"""SELECT class_name, n, {r('n / (SELECT sum(n) FROM counts) * 100.0::DOUBLE', 2)} AS percentage, (SELECT min(n) FROM counts) AS min_count, (SELECT max(n) FROM counts) AS max_count,
    {r('(SELECT max(n) FROM counts) / (SELECT min(n) FROM counts)', 2)} AS imbalance_ratio FROM counts""", "counts"))
def class_balance(spark, sf):
    return Sp.class_balance(listing(spark, sf))


@register("balanced_class_weights", query(f"SELECT class_name, n, {r('(SELECT sum(n) FROM counts) / ((SELECT count(*) FROM counts) * n)')} AS class_weight FROM counts", "counts"))
def balanced_class_weights(spark, sf):
    return Sp.balanced_class_weights(listing(spark, sf))


@register("stratified_split", query("SELECT relative_path, class_name, split FROM split_rows", "split_rows"))
def stratified_split(spark, sf):
    return split_rows(spark, sf).select("relative_path", "class_name", "split")


@register("grouped_stratified_split", query(f"""WITH src AS (SELECT *, {SOURCE.format(p='relative_path')} AS source_image_id FROM listing),
    g AS (SELECT source_image_id, min(class_name) AS c, count(*) AS size FROM src GROUP BY 1),
    f AS (SELECT *, (sum(size) OVER (PARTITION BY c ORDER BY {HASH.format(k='source_image_id')}, source_image_id) - size / 2.0::DOUBLE) / sum(size) OVER (PARTITION BY c) AS m FROM g)
    SELECT relative_path, class_name, source_image_id, CASE WHEN m < 4 / 6 THEN 'train' WHEN m < 4 / 6 + 1 / 6 THEN 'val' ELSE 'test' END AS split FROM src JOIN f USING (source_image_id)""", "listing"))
def grouped_stratified_split(spark, sf):
    rows = Sp.grouped_stratified_split(listing(spark, sf))
    return rows.select("relative_path", "class_name", "source_image_id", "split")


@register("cross_split_overlap", query("SELECT * FROM overlap", "overlap"))
def cross_split_overlap(spark, sf):
    return Sp.cross_split_overlap(Sp.add_source_image_id(split_rows(spark, sf)))


@register("split_overlap_audit", query("SELECT split, class_name, relative_path, source_image_id FROM sourced WHERE source_image_id IN (SELECT * FROM overlap)", "sourced", "overlap"))
def split_overlap_audit(spark, sf):
    return Sp.split_overlap_audit(split_rows(spark, sf))


@register("split_summary", query("""SELECT count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'val') AS val_rows, count(*) FILTER (split = 'test') AS test_rows,
    (SELECT count(*) FROM overlap) AS overlapping_source_ids, count(*) FILTER (source_image_id IN (SELECT * FROM overlap)) AS overlap_rows,
    count(DISTINCT class_name) FILTER (source_image_id IN (SELECT * FROM overlap)) AS classes_affected FROM sourced""", "sourced", "overlap"))
def split_summary(spark, sf):
    return Sp.split_summary(split_rows(spark, sf))


@register("split_counts", query("""SELECT class_name, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test, count(*) AS total FROM split_rows GROUP BY 1""", "split_rows"))
def split_counts(spark, sf):
    return Sp.split_counts(split_rows(spark, sf))


view(
    "oversampled",
    f"""SELECT relative_path, class_name, 0 AS copy FROM listing UNION ALL SELECT x.relative_path, x.class_name, d.copy FROM
        (SELECT class_name, c::INTEGER AS copy, ('0x' || substr(md5('42|' || class_name || '|' || c), 1, 8))::BIGINT % n + 1 AS rn FROM counts, unnest(generate_series(1, (SELECT max(n) FROM counts) - n)) g(c)) d
        JOIN (SELECT *, row_number() OVER (PARTITION BY class_name ORDER BY {HASH.format(k='relative_path')}, relative_path) AS rn FROM listing) x ON x.class_name = d.class_name AND x.rn = d.rn""",
    "listing", "counts",
)


@register("targeted_oversample", query("SELECT relative_path, class_name, copy, md5('42|' || relative_path || '|' || copy) AS shuffle_key FROM oversampled", "oversampled"))
def targeted_oversample(spark, sf):
    return Sp.targeted_oversample(listing(spark, sf), None, "relative_path").select("relative_path", "class_name", "copy", "shuffle_key")


@register("oversample_summary", query(f"""SELECT class_name, n AS before_count, a AS after_count, a - n AS added_rows, {r('a / n', 2)} AS ratio FROM counts
    JOIN (SELECT class_name, count(*) AS a FROM oversampled GROUP BY 1) USING (class_name)""", "counts", "oversampled"))
def oversample_summary(spark, sf):
    before = listing(spark, sf)
    return Sp.oversample_summary(before, Sp.targeted_oversample(before, None, "relative_path"))


@register("sample_per_class", query(f"""SELECT relative_path, class_name, (row_number() OVER (PARTITION BY class_name ORDER BY {HASH.format(k='relative_path')}, relative_path))::INTEGER AS sample_rank FROM listing
    WHERE class_name IN (SELECT class_name FROM counts ORDER BY class_name LIMIT 3) QUALIFY sample_rank <= 4""", "listing", "counts"))
def sample_per_class(spark, sf):
    return Sp.sample_per_class(listing(spark, sf), 4, 3, "relative_path").select("relative_path", "class_name", "sample_rank")


@register("dataset_checks", query("""SELECT count(DISTINCT class_name) = 4 AS class_count_ok, count(*) FILTER (class_name IS NULL) = 0 AS no_null_class, count(DISTINCT relative_path) = count(*) AS no_duplicate_path,
    count(DISTINCT (class_name, split)) = count(DISTINCT class_name) * 3 AS every_split_has_every_class FROM split_rows""", "split_rows"))
def dataset_checks(spark, sf):
    return Sp.dataset_checks(split_rows(spark, sf), 4)
