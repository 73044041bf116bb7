"""Small tables with every awkward case."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copy string, score string, lang_pred string, w string, fp string, key string, shard string, entity string"


def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing column names."""
    long = " ".join(f"word{i % 977} and {i % 31}" for i in range(20_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs away from the farm", "en", "a"),
        (2, "", "en", "a"),
        (3, None, None, None),
        (4, "   \n\t ", "en", "b"),
        (5, long, "en", "a"),
        (6, long, "en", "b"),
        (7, "1234 5678 !!!", None, "b"),
        (None, "le chat est sur la table et le chien est dans la maison avec les enfants", "fr", "b"),
        (9, "le chat est sur la table et le chien est dans la maison avec les enfants", "fr", None),
        (9, "le chat est sur la table et le chien est dans la maison avec les enfants", "fr", None),
        (10, "x" * 5000, "de", "a"),
    ]
    return spark.createDataFrame([(i, t, g, s, None if t is None else len(t), *["z"] * 8) for i, t, g, s in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
