"""Plain Spark SQL over the registered catalog tables of a small star."""

from hitparade.operators import star as star_ops
from hitparade.sinks import catalog
from hitparade.sinks import lake as lake_sink

TITRES = [
    (1, "Nocturne", 251, 900, 96.5, -7.0, False, 10, 7, "2024-02-01"),
    (2, "Quay", 143, 100, None, -3.0, True, 20, 9, "2024-02-01"),
    (3, "Ember", 309, 500, 171.0, -11.5, False, 10, 7, "2024-02-01"),
    (1, "Nocturne", 251, 880, 96.5, -7.0, False, 10, 7, "2024-03-01"),
]
ARTISTES = [(10, "Vesper", 52310, 3, "2024-02-01"), (20, "Lowtide", 77, 1, "2024-02-01"), (10, "Vesper", 60000, 4, "2024-03-01")]


def test_sql_over_catalog(spark, tmp_path):
    titres = spark.createDataFrame(
        TITRES,
        "id long, title string, duration int, rank long, bpm double, gain double, explicit_lyrics boolean,"
        " artist_id long, genre_id long, date_snapshot string",
    )
    artistes = spark.createDataFrame(ARTISTES, "id long, name string, nb_fan long, nb_album long, date string")
    root = str(tmp_path / "curated")
    lake_sink.publish_star(star_ops.build_star(titres, artistes), root)
    names = catalog.register_curated(spark, "charts_sql", root, db_location=str(tmp_path / "db"))
    catalog.recover_partitions(spark, names)

    def rows(sql):
        return [tuple(r) for r in spark.sql(sql).collect()]

    spark.sql("USE charts_sql")
    try:
        best = "SELECT date, max_by(id_titre, score_popularite), max(score_popularite) FROM fait_popularite GROUP BY date"
        assert sorted(rows(best)) == [("2024-02-01", 1, 900), ("2024-03-01", 1, 880)]
        gained = """
            SELECT nom, max(nb_fan) - min(nb_fan) AS more FROM dim_artiste GROUP BY nom HAVING count(*) > 1"""
        assert rows(gained) == [("Vesper", 7690)]
        slow = """
            SELECT a.nom, sum(t.duree) FROM fait_popularite f
            LEFT SEMI JOIN dim_date d ON d.date = f.date AND d.mois = 2
            JOIN dim_titre t USING (id_titre, date) JOIN dim_artiste a USING (id_artiste, date) GROUP BY a.nom"""
        assert sorted(rows(slow)) == [("Lowtide", 143), ("Vesper", 560)]
    finally:
        spark.sql("USE default")
