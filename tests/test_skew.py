"""Hot keys: a third of all chart rows on one title, one artist and one date.

The operators must give the same answer as a brute-force pandas computation,
and the plans must reduce hot groups before the shuffle (partial top-k /
partial aggregates), never ship them whole to one task.
"""

import pandas as pd
from pyspark.sql import functions as F

from hitparade.operators import ingest, quality
from hitparade.operators import star as star_ops
from hitparade.plans import reports
from hitparade.sources import landing

SF = "/root/testdata/sf0.001"
HOT_TITLE, HOT_ARTIST, HOT_DATE = 7, 3, "1998-03-01"


def skewed_entries(spark):
    e = landing.chart_entries(spark, SF)
    hot = F.pmod(F.col("position"), F.lit(3)) == 0  # test fixture only: one row in three
    return e.select(
        F.when(hot, F.lit(HOT_DATE)).otherwise(F.col("date_snapshot")).alias("date_snapshot"),
        F.when(hot, F.lit(HOT_TITLE).cast("long")).otherwise(F.col("id")).alias("id"),
        "genre_id",
        "position",
        F.when(hot, F.lit(HOT_ARTIST).cast("long")).otherwise(F.col("artist_id")).alias("artist_id"),
        "rank",
        "explicit_lyrics",
    )


def test_first_seen_on_hot_title_matches_brute_force(spark):
    entries = skewed_entries(spark)
    pdf = entries.toPandas()
    assert (pdf["id"] == HOT_TITLE).mean() > 0.3
    expected = (
        pdf.sort_values(["genre_id", "position", "artist_id", "rank"])
        .groupby(["date_snapshot", "id"], as_index=False)
        .first()
    )
    kept = ingest.first_seen(entries)
    got = kept.toPandas()
    cols = ["date_snapshot", "id", "genre_id", "position", "artist_id", "rank"]
    pd.testing.assert_frame_equal(
        got[cols].sort_values(cols[:2]).reset_index(drop=True),
        expected[cols].sort_values(cols[:2]).reset_index(drop=True),
        check_dtype=False,
    )
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_uniqueness_and_r5_with_hot_artist(spark):
    entries = skewed_entries(spark)
    titres = landing.with_titles(entries, landing.title_records(spark, SF)).select(
        "id", "title", "duration", "rank", "bpm", "gain", "explicit_lyrics", "artist_id", "genre_id", "date_snapshot"
    )
    fait = star_ops.build_fait_popularite(titres)
    pdf = fait.toPandas()
    dups = int(pdf.duplicated(subset=["id_titre", "date_snapshot"]).sum())
    assert quality.check_unicite(fait).first().violations == dups > 0

    artistes = ingest.enrich_artists(titres, landing.artist_records(spark, SF)).select(
        "id", "name", "nb_fan", "nb_album", F.col("date_snapshot").alias("date")
    )
    s = star_ops.Star(fait, star_ops.build_dim_titre(titres), star_ops.build_dim_artiste(artistes), None)
    got = {r.id_artiste: (r.score_popularite_moyen, r.nb_titres_classes) for r in reports.emerging_artists(s, None, k=1000).collect()}
    dim = s.dim_artiste.toPandas()
    j = pdf.merge(dim, on=["id_artiste", "date"])
    j = j[j["nb_fan"] < 500_000]
    exp = j.groupby("id_artiste").agg(avg=("score_popularite", "mean"), n=("score_popularite", "size"))
    assert set(got) == set(exp.index)
    for a, row in exp.iterrows():
        assert got[a][1] == row["n"] and abs(got[a][0] - row["avg"]) < 1e-9 * max(1.0, row["avg"])
