"""Clinical-looking views over the TPC-H-like test tables (FIXTURES.md).

Every expression is SQL that Spark and DuckDB read the same way, so one text
feeds both the Spark query and its DuckDB oracle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PREOP_COLUMNS = {
    "k": "o_orderkey",
    "CODIGO": "'C' || CAST(o_orderkey AS STRING)",
    "Documento PMD": "'D' || CAST(o_orderkey - CASE WHEN o_orderkey % 50 = 49 THEN 1 ELSE 0 END AS STRING)",
    "Fecha": "o_orderdate",
    "Hora": "CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'sin hora' ELSE lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':' || lpad(CAST(o_orderkey * 7 % 60 AS STRING), 2, '0') END",
    "Edad": "CAST(CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 115 WHEN o_orderkey % 89 = 0 THEN 200 ELSE 5 + o_orderkey * 7 % 90 END AS DOUBLE)",
    "Peso (Kg)": "CAST(CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE 30 + o_orderkey * 13 % 100 END AS DOUBLE)",
    "Talla (cm)": "CAST(120 + o_orderkey * 11 % 90 AS DOUBLE)",
    "IMC": "CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 14 + o_orderkey % 24 END AS DOUBLE)",
    "Tensión Arterial Sistólica (mm/Hg)": "CAST(50 + o_orderkey * 17 % 230 AS DOUBLE)",
    "Tensión Arterial Diastólica (mm/Hg)": "CAST(25 + o_orderkey * 19 % 150 AS DOUBLE)",
    "Tensión Arterial Media (mm/Hg)": "CAST(CASE o_orderkey % 3 WHEN 0 THEN 20 WHEN 1 THEN 92 ELSE NULL END AS DOUBLE)",
    "Frecuencia Respiratoria": "CAST(5 + o_orderkey * 3 % 70 AS DOUBLE)",
    "Temperatura": "CASE o_orderkey % 11 WHEN 0 THEN 'afebril' WHEN 1 THEN NULL ELSE CAST(20 + o_orderkey % 27 AS STRING) END",
    "Sexo": "CASE o_orderkey % 6 WHEN 0 THEN 'masculino' WHEN 1 THEN 'Mujer' WHEN 2 THEN 'M' WHEN 3 THEN 'F' WHEN 4 THEN ' hombre ' ELSE 'F' END",
    "Atención": "CASE o_orderkey % 4 WHEN 0 THEN 'urgente' WHEN 1 THEN 'Electivo' WHEN 2 THEN 'programado' ELSE 'Urgencia Programada' END",
    "Grupo Sanguíneo": "CASE o_orderkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'AB' WHEN 3 THEN 'O' ELSE NULL END",
    "RH": "CASE o_orderkey % 2 WHEN 0 THEN 'Positivo' ELSE 'Negativo' END",
    "Clase Funcional (NYHA) ": "CASE o_orderkey % 5 WHEN 0 THEN 'I' WHEN 1 THEN 'II' WHEN 2 THEN 'III' WHEN 3 THEN 'IV' ELSE NULL END",
    "Cuello Móvil": "CASE o_orderkey % 4 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Reducido' WHEN 2 THEN 'Fijo' ELSE NULL END",
    "Apertura Oral": "CASE o_orderkey % 2 WHEN 0 THEN '> 3 cm' ELSE '< 3 cm' END",
    "Puntaje Mallampati": "CAST(1 + o_orderkey % 4 AS DOUBLE)",
    "Estado Nutricional": "CASE o_orderkey % 3 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Sobrepeso' ELSE NULL END",
    "Color de Piel": "CASE o_orderkey % 4 WHEN 0 THEN 'Rosada' WHEN 1 THEN 'Pálida' WHEN 2 THEN ' ictérica ' ELSE NULL END",
    "Sistema Nervioso": "CASE o_orderkey % 4 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Confuso, Somnolencia' WHEN 2 THEN 'Somnolencia' ELSE NULL END",
    "Apertura Visual": "CASE o_orderkey % 5 WHEN 0 THEN 'Espontánea' WHEN 1 THEN 'A la voz' WHEN 2 THEN 'Al dolor' WHEN 3 THEN 'Ninguna' ELSE NULL END",
    "Respuesta Verbal": "CASE o_orderkey % 4 WHEN 0 THEN 'Conversación orientada' WHEN 1 THEN 'Conversación confusa' WHEN 2 THEN 'Ninguna' ELSE NULL END",
    "Respuesta Motora": "CASE o_orderkey % 4 WHEN 0 THEN 'Obedece órdenes' WHEN 1 THEN 'Localiza el dolor' WHEN 2 THEN 'Flácido' ELSE NULL END",
    "Sistema Respiratorio": "CASE o_orderkey % 5 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Disnea, Roncus' WHEN 2 THEN 'Sibilancias;' WHEN 3 THEN 'disnea' ELSE NULL END",
    "Sistema cardiovascular": "CASE o_orderkey % 3 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Soplo sistólico' ELSE NULL END",
    "Abdomen": "CASE o_orderkey % 3 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Distendido, Doloroso' ELSE NULL END",
    "Arritmia": "CASE o_orderkey % 9 WHEN 0 THEN 'Si' ELSE 'No' END",
    "Angina": "CASE o_orderkey % 8 WHEN 0 THEN 'X' ELSE NULL END",
    "Condición": "CASE o_orderkey % 4 WHEN 0 THEN 'Lúcido; Orientado' WHEN 1 THEN 'Alerta' WHEN 2 THEN 'Alerta, Orientado' ELSE NULL END",
    "Tipo de anestesia propuesta": "CASE o_orderkey % 5 WHEN 0 THEN 'General' WHEN 1 THEN 'Raquídea' WHEN 2 THEN 'General, Epidural' WHEN 3 THEN 'Local' ELSE NULL END",
    "Prótesis Dental": "CASE o_orderkey % 3 WHEN 0 THEN 'Móvil' WHEN 1 THEN 'No' ELSE NULL END",
    "Alérgeno": "CASE o_orderkey % 9 WHEN 0 THEN 'Penicilina, látex' WHEN 1 THEN 'niega' WHEN 2 THEN 'AMOXACILINA / mariscos' WHEN 3 THEN 'Ibuprofeno y dipirona' WHEN 4 THEN '-' WHEN 5 THEN 'cefalotina' WHEN 6 THEN 'zzz desconocida' WHEN 7 THEN 'Yodo' ELSE NULL END",
    "Antecedente neurológicos": "CASE o_orderkey % 5 WHEN 0 THEN 'Epilepsia, Negativo' WHEN 1 THEN 'negativo' WHEN 2 THEN 'ACV; Epilepsia' WHEN 3 THEN 'Migraña' ELSE NULL END",
    "Antecedentes cardiovasculares": "CASE o_orderkey % 4 WHEN 0 THEN 'HTA' WHEN 1 THEN 'HTA, FA' WHEN 2 THEN 'Negativo' ELSE NULL END",
    "Antecedente respiratorios": "CASE o_orderkey % 4 WHEN 0 THEN 'Asma' WHEN 1 THEN 'EPOC, Asma' WHEN 2 THEN 'Negativo' ELSE NULL END",
    "Antecedentes anestésicos": "CAST(CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE NULL END AS DOUBLE)",
    "Antecedentes quirúrgicos": "CASE o_orderkey % 4 WHEN 0 THEN 'apendicectomía 2015' WHEN 1 THEN 'cesárea' WHEN 2 THEN 'nan' ELSE NULL END",
    "Anestesia previa": "CASE o_orderkey % 7 WHEN 0 THEN 'anest gral' WHEN 1 THEN 'A G' WHEN 2 THEN 'raquida + sed' WHEN 3 THEN 'co nductiva' WHEN 4 THEN 'otra cosa' WHEN 5 THEN 'localsedacion' ELSE NULL END",
    "Examen": "CASE o_orderkey % 8 WHEN 0 THEN 'Hemoglobina(g/dl)' WHEN 1 THEN 'PT (INR)' WHEN 2 THEN 'Hematocrito (%)' WHEN 3 THEN 'Plaquetas (ml)' WHEN 4 THEN 'Leucocitos (ml)' WHEN 5 THEN 'PTT' WHEN 6 THEN 'P de O' ELSE 'Otro' END",
    "Resultado de examen de laboratorio": "CASE o_orderkey % 24 WHEN 0 THEN '13,5' WHEN 8 THEN '<11.2 g' WHEN 16 THEN NULL WHEN 1 THEN '12.5/1.1' WHEN 9 THEN '1,05' WHEN 17 THEN '23' WHEN 2 THEN '41%' WHEN 10 THEN '140%' WHEN 18 THEN '38,2' WHEN 3 THEN '250.000' WHEN 11 THEN '180000' WHEN 19 THEN '210' WHEN 4 THEN '7.500' WHEN 12 THEN '9,8' WHEN 20 THEN 'x' WHEN 5 THEN '30/28' WHEN 13 THEN '31.5' WHEN 21 THEN '~29' WHEN 6 THEN 'UROCULTIVO' WHEN 14 THEN 'NORMAL' ELSE 'otro' END",
    "Nombre del medicamento": "CASE o_orderkey % 5 WHEN 0 THEN 'Losartán' WHEN 1 THEN 'niega' WHEN 2 THEN 'la metformina' WHEN 3 THEN 'ASPIRINA' ELSE NULL END",
    "Dx Preoperatorio": "CASE o_orderkey % 5 WHEN 0 THEN 'Hernia inguinal' WHEN 1 THEN 'catarata del ojo' WHEN 2 THEN 'fractura de fémur' WHEN 3 THEN 'xyz' ELSE NULL END",
    "Procedimiento propuesto": "CASE o_orderkey % 4 WHEN 0 THEN 'herniorrafia inguinal' WHEN 1 THEN 'facoemulsificación' WHEN 2 THEN 'laparotomía exploratoria' ELSE NULL END",
}

for _name in (
    "Antecedente hematológicos ",
    "Antecedente endocrinológicos",
    "Antecedente renales",
    "Antecedente gastrointestinales",
):
    PREOP_COLUMNS[_name] = PREOP_COLUMNS["Antecedente respiratorios"]

POSOP_COLUMNS = {
    "k": "o_orderkey",
    "Documento PMD (valoración preanestésica)": "'D' || CAST(o_orderkey AS STRING)",
    "Cirugia": "CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE 'S' END",
    "Otros procedimientos": "CASE WHEN o_orderkey % 24 = 12 THEN 'P' ELSE NULL END",
    "Cancelación de procedimiento - episodio consulta preanes": "CASE o_orderkey % 36 WHEN 0 THEN 'C-CA por Médico' WHEN 6 THEN 'C-CA paciente' ELSE NULL END",
    "Cancelación de procedimiento - episodio procedimiento": "CASE WHEN o_orderkey % 72 = 24 THEN 'x C-CA por Médico' ELSE NULL END",
    "Reserva de hemoderivados": "CASE WHEN o_orderkey % 19 = 0 THEN 912002 ELSE NULL END",
    "Reserva de sangre ": "CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END",
    "Presión arterial sistólica prequirúrgica ": "CAST(CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderkey * 7 % 230 END AS DOUBLE)",
    "Presión arterial diastólica prequirúrgica": "CAST(o_orderkey * 11 % 170 AS DOUBLE)",
    "Presión arterial media prequirúrgica": "CAST(o_orderkey * 13 % 210 AS DOUBLE)",
    "Frecuencia cardiaca prequirúrgica": "CAST(o_orderkey * 17 % 210 AS DOUBLE)",
    "Saturación de oxígeno prequirúrgica": "CAST(88 + o_orderkey % 14 AS DOUBLE)",
    "Temperatura prequirúrgica": "CAST(28 + o_orderkey % 19 AS DOUBLE)",
    "Glucometría prequirúrgica ": "CASE WHEN o_orderkey % 37 = 0 THEN 1 ELSE NULL END",
    "Valor glucometria ": "CASE o_orderkey % 6 WHEN 0 THEN 'NR' WHEN 1 THEN NULL ELSE CAST(o_orderkey * 29 % 650 AS STRING) END",
    "Inicio cirujano ": "'2024-03-01 08:' || lpad(CAST(o_orderkey % 60 AS STRING), 2, '0') || ':00'",
    "Fin cirujano ": "CASE WHEN o_orderkey % 43 = 0 THEN 'pendiente' ELSE '2024-03-01 ' || lpad(CAST(9 + o_orderkey * 3 % 10 AS STRING), 2, '0') || ':' || lpad(CAST(o_orderkey * 7 % 60 AS STRING), 2, '0') || ':00' END",
    "Inicio anestesia ": "'2024-03-01 07:' || lpad(CAST(o_orderkey * 3 % 60 AS STRING), 2, '0') || ':00'",
    "Fin anestesia ": "'2024-03-01 ' || lpad(CAST(10 + o_orderkey * 5 % 12 AS STRING), 2, '0') || ':30:00'",
    "Clase de inducción ": "CASE o_orderkey % 4 WHEN 0 THEN 'Intravenosa' WHEN 1 THEN ' mixta ' WHEN 2 THEN 'Inhalatoria' ELSE NULL END",
    "Intubación  ": "CASE o_orderkey % 9 WHEN 0 THEN 'DIFICIL' WHEN 1 THEN 'imposible' WHEN 2 THEN NULL ELSE 'Facil' END",
    "Laringoscopia ": "CASE o_orderkey % 7 WHEN 0 THEN 'NA' ELSE CAST(1 + o_orderkey % 4 AS STRING) END",
    "Tipo de intubación": "CASE o_orderkey % 11 WHEN 0 THEN 'nasotraqueal' WHEN 1 THEN 'Otro' ELSE 'Orotraqueal' END",
    "Hoja de laringoscopio ": "CASE o_orderkey % 13 WHEN 0 THEN 'Recta' ELSE 'curva' END",
    "Elemento de vía aérea utilizado ": "CASE o_orderkey % 17 WHEN 0 THEN 'fibrolaringoscopio' ELSE 'Tubo Endotraqueal' END",
    "Ventilación asistida ": "CASE WHEN o_orderkey % 15 = 0 THEN 'X' ELSE NULL END",
    "Control manual ": "CASE WHEN o_orderkey % 16 = 0 THEN ' X' ELSE NULL END",
    "SIMV/PS": "CASE WHEN o_orderkey % 29 = 0 THEN 'X' ELSE NULL END",
    "Presión soporte ": "CASE WHEN o_orderkey % 33 = 0 THEN 'x' ELSE NULL END",
    "Frecuencia respiratoria ": "CASE WHEN o_orderkey % 10 = 0 THEN 'nd' ELSE CAST(o_orderkey % 32 AS STRING) END",
    "Técnica anestésica ": "CASE o_orderkey % 4 WHEN 0 THEN 'General,Regional' WHEN 1 THEN 'General' WHEN 2 THEN 'Local' ELSE NULL END",
    "Monitoreo ": "CASE o_orderkey % 5 WHEN 0 THEN 'ECG, pvc' WHEN 1 THEN 'Temperatura' ELSE 'ECG' END",
    "Líquidos administrados ": "CASE o_orderkey % 18 WHEN 0 THEN 'Hemoderivados' ELSE 'Cristaloides' END",
    "Liquidos eliminados": "CASE o_orderkey % 21 WHEN 0 THEN 'Plasma y orina' ELSE NULL END",
    "VOLUMEN LIQUIDOS ADMINISTRADOS": "CAST(o_orderkey * 31 % 2500 AS STRING)",
    "Volumen de liquidos eliminados ": "CASE WHEN o_orderkey % 14 = 0 THEN 'sd' ELSE CAST(o_orderkey * 37 % 1200 AS STRING) END",
    "Balance de líquidos ": "CAST(o_orderkey * 41 % 3600 - 1200 AS STRING)",
    "Destino final ": "CASE o_orderkey % 25 WHEN 0 THEN 'uci' WHEN 1 THEN ' Otro' ELSE 'UCPA' END",
    "Estado intubación ": "CASE o_orderkey % 20 WHEN 0 THEN 'INTUBADO' ELSE 'Extubado' END",
    "Complicaciones ": "CASE o_orderkey % 27 WHEN 0 THEN 'X' ELSE NULL END",
    "Infarto de miocardio en hospital": "CASE WHEN o_orderkey % 101 = 0 THEN 'I214' ELSE NULL END",
    "Accidente cerebrovascular isquémico": "CASE WHEN o_orderkey % 103 = 0 THEN 'I639' ELSE NULL END",
    "Accidente cerebrovascular hemorrágico": "CASE WHEN o_orderkey % 107 = 0 THEN 'I619' ELSE NULL END",
    "Ataque isquémico transitorio (TIA)": "CASE WHEN o_orderkey % 109 = 0 THEN 'G459' ELSE NULL END",
    "Aspiración pulmonar": "CASE WHEN o_orderkey % 113 = 0 THEN 'J690' ELSE NULL END",
    "Complicaciones pulmonares posoperatorias ": "CASE WHEN o_orderkey % 61 = 0 THEN 'J958' ELSE NULL END",
    "Estancia hospitalaria ": "CASE o_orderkey % 4 WHEN 0 THEN 'amb' WHEN 1 THEN NULL ELSE CAST(o_orderkey % 9 AS STRING) END",
    "Hospitalización no anticipada": "CASE o_orderkey % 6 WHEN 0 THEN ' X' WHEN 1 THEN 'no' ELSE NULL END",
    "Admisión a cuidado intensivo no planeada": "CASE WHEN o_orderkey % 47 = 0 THEN '2024-03-02' ELSE NULL END",
    "Estancia en UCI ": "CASE WHEN o_orderkey % 47 = 0 THEN CAST(o_orderkey % 3 AS STRING) ELSE NULL END",
    "Consulta a urgencias en los siguientes 30 días": "CASE WHEN o_orderkey % 22 = 0 THEN '2024-03-20' ELSE NULL END",
    "Necesidad de interconsultas a otras especialidades médicas": "CASE o_orderkey % 26 WHEN 0 THEN 'x' ELSE NULL END",
}

SCORED_COLUMNS = {
    "row_key": "event_id",
    "y_true": "CASE WHEN value + event_id * 53 % 80 > 90 THEN 1 ELSE 0 END",
    "y_proba": "floor((0.8 * value / (value + 60) + CAST(event_id * 37 % 100 AS DOUBLE) / 500) * 1000) / 1000",
    "version": "'v' || CAST(event_id % 3 AS STRING)",
    "model": "'m' || CAST(event_id % 4 AS STRING)",
    "Edad": "CAST(18 + user_id * 7 % 80 AS DOUBLE)",
    "severity": "CAST(event_id % 6 AS INT)",
    "group_type": "event_type",
    "feat_a": "value",
    "feat_b": "CAST(event_id * 29 % 97 AS DOUBLE)",
    "feat_c": "CAST(user_id % 12 AS DOUBLE)",
}

#: view name -> (base table, columns, row filter)
VIEWS = {
    "preop_v": ("orders", PREOP_COLUMNS, None),
    "posop_v": ("orders", POSOP_COLUMNS, "o_orderkey % 5 <> 4"),
    "scored_v": ("events", SCORED_COLUMNS, None),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, columns, where = VIEWS[name]
    df = table(spark, sf_dir, base)
    if where:
        df = df.where(where)
    return df.selectExpr(*[f"{expr} AS `{col}`" for col, expr in columns.items()])


def preop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "preop_v")


def posop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "posop_v")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "scored_v")


def duckdb_cte(name: str) -> str:
    base, columns, where = VIEWS[name]
    select = ", ".join(f'{expr} AS "{col}"' for col, expr in columns.items())
    return f"{name} AS (SELECT {select} FROM {base}" + (f" WHERE {where})" if where else ")")
