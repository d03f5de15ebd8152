import json

from pyspark.sql import functions as F

from rodaje.operators import drift

SCHEMA = "archivo_id long, serie string, orden int, linea int, registro string, field string"


def lines(spark, files):
    data = [(a, s, o, i, r if isinstance(r, (str, type(None))) else json.dumps(r), "x") for a, s, o, rs in files for i, r in enumerate(rs)]
    return spark.createDataFrame(data, SCHEMA)


def changes(spark, files):
    return {(r.file, r.field, r.change) for r in drift.schema_changes(lines(spark, files)).collect()}


def test_each_kind_of_change(spark):
    files = [
        (1, "S", 1, [{"periodo": "2026/01", "iva": 1.5, "turno": "a"}, '{"periodo": "2026', None, "7"]),
        (2, "S", 3, [{"Período": "2026/02", "iva": "1,5"}, {"exemtos": True}]),
        (3, "S", 4, [{"periodo": None, "exentos": None, "iva": "2"}]),
        (4, "T", 1, [{"periodo": 1}]),
    ]
    assert changes(spark, files) == {
        (2, "turno", "quitado"), (2, "periodo", "renombrado"), (2, "iva", "tipo"), (2, "exentos", "agregado"),
        (3, "periodo", "renombrado"), (3, "exentos", "renombrado"),
    }


def test_file_without_valid_lines_and_empty_table(spark):
    assert changes(spark, [(1, "S", 1, [{"iva": 1}]), (2, "S", 2, ["{", ""])]) == {(2, "iva", "quitado")}
    assert changes(spark, []) == set()


def test_proper_names(spark):
    names = {"PRECIO SURTIDOR": "precio_surtidor", "precioSurtidor": "precio_surtidor", "precio_anterior": "precio_anterior", "EXENTOS (S/N)": "exentos", "exentos_detalle": "exentos_detalle", "produto": "producto", "nro. inscripcion": "nro_inscripcion", "volumen_acum": "volumen_acum", "IVA": "iva", "no_movimentos": "no_movimientos", "volumen1": "volumen1", "volumen2": "volumen2", "provincia2": "provincia2", "productos": "productos", "operadora": "operadora", "periodos": "periodos", "exento": "exentos"}
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", drift.proper_name(F.col("n")).alias("p"))
    assert dict(df.collect()) == names


def test_unified_table_has_the_types_all_files_can_be_read_as(spark):
    files = [
        (1, "S", 1, [{"Volumen": "69,5", "EXENTOS (S/N)": "t", "turno": "noche", "iva": None, "periodo": "2026/01", "no_mov": "2026-01-31", "nro_inscripcion": "0012"}, "{"]),
        (2, "S", 2, [{"vol": 3, "exento": 0, "periodo": 202602, "nro_inscripcion": 7}, {"tasa_municipal": "1.5", "iva": True}]),
        (3, "S", 3, [{"tasa_municipal": "exenta", "no_movimientos": "2026-02-28"}]),
    ]
    out = drift.unified(lines(spark, files), ["serie"])
    kinds = dict(out.dtypes)
    assert {f: kinds[f] for f in ("volumen", "exentos", "periodo", "no_movimientos", "nro_inscripcion", "tasa_municipal", "iva", "operador")} == {
        "volumen": "double", "exentos": "boolean", "periodo": "string", "no_movimientos": "date", "nro_inscripcion": "bigint",
        "tasa_municipal": "string", "iva": "boolean", "operador": "string",
    }
    got = [(r.archivo_id, r.linea, r.volumen, r.exentos, r.periodo, r.nro_inscripcion, r.tasa_municipal, r.otros) for r in out.orderBy("archivo_id", "linea").collect()]
    assert got == [
        (1, 0, 69.5, True, "2026/01", 12, None, {"turno": "noche"}), (2, 0, 3.0, False, "202602", 7, None, None),
        (2, 1, None, None, None, None, "1.5", None), (3, 0, None, None, None, None, "exenta", None),
    ]
    named = drift.unified(lines(spark, files), [], types={"tasa_municipal": "double"})
    assert dict(named.dtypes)["tasa_municipal"] == "double"
    assert drift.unified(lines(spark, []), ["serie"]).count() == 0


def test_union_schema_and_spellings(spark):
    files = [(1, "S", 1, [{"vol": 1, "x": "a"}, {"vol": "2,5"}]), (2, "S", 1, [{"volumne": 1, "volumen": None, "volumn": 3}])]
    df = lines(spark, files)
    assert {(r.field, r.type, r.files, r.delivered) for r in drift.union_schema(df).collect()} == {
        ("volumen", "double", 2, "number,text"), ("x", "string", 1, "text"), ("volumne", "bigint", 1, "number"),
    }
    assert {(r.written, r.field, r.rule, r.files) for r in drift.spellings(df).collect()} == {
        ("vol", "volumen", "lista", 1), ("x", "x", "propio", 1), ("volumen", "volumen", "nombre", 1), ("volumn", "volumen", "errata", 1),
        ("volumne", "volumne", "propio", 1),
    }
