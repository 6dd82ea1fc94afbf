"""Reading and writing tables, reports and schema contracts."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.numeric import col

KEY = "Documento PMD"
KEY_ALIAS = "Documento PMD (valoración preanestésica)"


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet table; a missing path is an error, not an empty frame."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def unique_columns(df: DataFrame) -> DataFrame:
    """First column of each name, where a name is repeated."""
    names = df.columns
    first = [i for i, n in enumerate(names) if n not in names[:i]]
    if len(first) == len(names):
        return df
    numbered = df.toDF(*[f"_{i}" for i in range(len(names))])
    return numbered.select(*[F.col(f"_{i}").alias(names[i]) for i in first])


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Nulls stay nulls: no column is cast to text on the way out."""
    unique_columns(df).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def landed(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder has ended: it holds Spark's success mark, which its readers hide."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def land_pair(
    spark: SparkSession, preop: DataFrame | str, postop: DataFrame | str, out_dir: str,
    schemas: tuple[T.StructType | None, T.StructType | None] = (None, None),
) -> tuple[DataFrame, DataFrame]:
    """Write both raw tables once; later calls read the landed copies.

    A copy counts as landed when its write has ended; a half-written one is written again. CSV
    files are read as texts and then take the given schema (for preop RAW_SCHEMA, say; columns that it
    doesn't name stay texts). The long key name of the postop table is shortened here, once.
    """
    out = []
    for name, source, schema in zip(("preop_raw", "postop_raw"), (preop, postop), schemas):
        path = f"{out_dir}/{name}.parquet"
        if not landed(spark, path):
            df = spark.read.csv(source, header=True) if isinstance(source, str) else source
            if isinstance(source, str) and schema is not None:
                kinds = {f.name: f.dataType for f in schema}
                df = df.select(*[col(c).try_cast(kinds[c]).alias(c) if c in kinds else col(c) for c in df.columns])
            if KEY_ALIAS in df.columns and KEY not in df.columns:
                df = df.withColumnRenamed(KEY_ALIAS, KEY)
            write_parquet(df, path)
        out.append(spark.read.parquet(path))
    return out[0], out[1]


def write_csv_report(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").csv(path, header=True, emptyValue="")
    return path


def read_csv_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


METRIC_FIELDS = ("F2", "ROC_AUC", "Recall", "Precision", "Threshold")


def collect_metrics(
    spark: SparkSession,
    root: str,
    files: str = "*/*_metrics.json",
    target: str = r"([^/]+)/[^/]+_metrics\.json(?:/part-[^/]*)?$",
    model: str = r"([^/]+)_metrics\.json(?:/part-[^/]*)?$",
) -> DataFrame:
    """One row per metrics file, target and model from its path; target, then F2 descending.

    The default patterns read <target>/<model>_metrics.json. `split` says which rows the
    metrics were measured on (validation when the file does not say).
    """
    schema = T.StructType(
        [T.StructField(f, T.DoubleType()) for f in METRIC_FIELDS] + [T.StructField("split", T.StringType())]
    )
    raw = spark.read.schema(schema).json(f"{root}/{files}", multiLine=True)
    path = F.url_decode(F.input_file_name())
    return raw.select(
        F.regexp_extract(path, target, 1).alias("target"),
        F.regexp_extract(path, model, 1).alias("model"),
        *METRIC_FIELDS,
        F.coalesce("split", F.lit("validation")).alias("split"),
    ).orderBy("target", F.desc("F2"))


def schema_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order: cast, missing ones null, others dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def _fields(kind: T.DataType, names: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names]


# The raw preop fields the engine accepts.
RAW_NUMBERS = [
    "Edad", "Peso (Kg)", "Talla (cm)", "IMC", "Tensión Arterial Sistólica (mm/Hg)",
    "Tensión Arterial Diastólica (mm/Hg)", "Tensión Arterial Media (mm/Hg)", "Frecuencia Respiratoria",
    "Temperatura", "Examen_Hemoglobina(g/dl)", "Examen_PT (INR)", "Puntaje Mallampati",
]
RAW_TEXTS = [
    "Sexo", "Atención", "Fecha", "Hora", "Grupo Sanguíneo", "RH", "Antecedente neurológicos",
    "Antecedente respiratorios", "Antecedentes cardiovasculares", "Antecedente hematológicos ",
    "Antecedente endocrinológicos", "Antecedente renales", "Antecedente gastrointestinales",
    "Antecedentes anestésicos", "Antecedentes quirúrgicos", "Anestesia previa",
    "Clase Funcional (NYHA) ", "Cuello Móvil", "Apertura Oral", "Estado Nutricional", "Color de Piel",
    "Sistema Nervioso", "Apertura Visual", "Respuesta Verbal", "Respuesta Motora", "Sistema Respiratorio",
    "Sistema cardiovascular", "Abdomen", "Arritmia", "Angina", "Condición", "Tipo de anestesia propuesta",
    "Prótesis Dental", "Alérgeno", "Dx Preoperatorio", "Procedimiento propuesto",
]
RAW_SCHEMA = T.StructType(_fields(T.DoubleType(), RAW_NUMBERS) + _fields(T.StringType(), RAW_TEXTS))


def version_partitions(
    merged: DataFrame, features: DataFrame, active: DataFrame | None = None, column: str = "version"
) -> DataFrame:
    """Versions that have both a merged table and a feature list (and are active), with a marker.

    On tables partitioned by version the distinct reads directory names and no data.
    """
    common = merged.select(column).distinct().intersect(features.select(column).distinct())
    if active is None:
        return common.withColumn("status", F.lit("used"))
    wanted = active.select(column).distinct()
    used = common.intersect(wanted).withColumn("status", F.lit("used"))
    ignored = common.exceptAll(wanted).withColumn("status", F.lit("ignored"))
    return used.unionByName(ignored)
