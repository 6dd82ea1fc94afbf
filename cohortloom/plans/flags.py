"""Postoperative outcome flags: thirteen families of 0/1 rules over the postop table."""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import any_flag, col, flag, to_number
from cohortloom.functions.dates import duration_minutes
from cohortloom.operators.ordered import exact_quantiles

CANCEL_MARK = "C-CA por Médico"
BLOOD_RESERVE_CODE = 912002

# Vital sign rules.
# column -> flag, normal low, normal high, value used when invalid, possible low, possible high
VITAL_RULES = {
    "Presión arterial sistólica prequirúrgica ": ("flag_presion_sistolica_anormal", 80, 150, 115.0, 50, 200),
    "Presión arterial diastólica prequirúrgica": ("flag_presion_diastolica_anormal", 50, 100, 75.0, 20, 150),
    "Presión arterial media prequirúrgica": ("flag_presion_media_anormal", 60, 115, 87.5, 25, 200),
    "Frecuencia cardiaca prequirúrgica": ("flag_frecuencia_cardiaca_anormal", 50, 110, 80.0, 25, 200),
    "Saturación de oxígeno prequirúrgica": ("flag_saturacion_oxigeno_anormal", 95, None, 98.0, 50, 100),
    "Temperatura prequirúrgica": ("flag_temperatura_anormal", 35, 37.5, 36.75, 30, 45),
}
GLUCOSE_NORMAL, GLUCOSE_LOW, GLUCOSE_HIGH, GLUCOSE_POSSIBLE = 100.0, 70, 180, (20, 600)

# Complication columns and their flags.
COMPLICATIONS = {
    "flag_infarto_miocardio": "Infarto de miocardio en hospital",
    "flag_acv_isquemico": "Accidente cerebrovascular isquémico",
    "flag_acv_hemorragico": "Accidente cerebrovascular hemorrágico",
    "flag_tia": "Ataque isquémico transitorio (TIA)",
    "flag_aspiracion_pulmonar": "Aspiración pulmonar",
    "flag_complicaciones_pulmonares": "Complicaciones pulmonares posoperatorias ",
}


def _word(name: str) -> Column:
    """Trimmed, lower-cased text, for comparison with single words."""
    return F.lower(F.trim(col(name)))


def invalid_to_normal(c: Column | str, normal: float, low: float, high: float) -> Column:
    """Null, zero or physically impossible values become the normal value."""
    c = to_number(c)
    return F.when((c != 0) & (c >= low) & (c <= high), c).otherwise(F.lit(normal))


def outside(c: Column | str, low: float | None, high: float | None) -> Column:
    c = col(c)
    cond = F.lit(False)
    if low is not None:
        cond = cond | (c < F.lit(low))
    if high is not None:
        cond = cond | (c > F.lit(high))
    return flag(cond)


@dataclass(frozen=True)
class Family:
    """Rules of one family, kept as expressions so that all families share one projection.

    clean: columns rewritten before the rules look at them; parts: the 0/1 rules;
    members: the parts that enter the family flag by OR; drops: columns not needed afterwards.
    """

    flag: str
    parts: Callable[..., dict[str, Column]]
    members: tuple[str, ...]
    clean: Callable[[], dict[str, Column]] = field(default=dict)
    drops: tuple[str, ...] = ()


_CANCEL_TEXTS = (
    "Cancelación de procedimiento - episodio consulta preanes",
    "Cancelación de procedimiento - episodio procedimiento",
)


def _cancelacion(**_: object) -> dict[str, Column]:
    by_doctor = F.lit(False)
    for t in _CANCEL_TEXTS:
        by_doctor = by_doctor | F.coalesce(col(t).contains(CANCEL_MARK), F.lit(False))
    cancelled = col("Cirugia").isNull() & col("Otros procedimientos").isNull()
    return {
        "canceladas": flag(cancelled),
        "canceladas_por_medico": flag(by_doctor),
        "_cancelada_medico": flag(cancelled & by_doctor),
    }


def _reservas(**_: object) -> dict[str, Column]:
    return {
        "flag_reserva_hemoderivados": flag(col("Reserva de hemoderivados") == BLOOD_RESERVE_CODE),
        "flag_reserva_sangre": flag(col("Reserva de sangre ") == 1),
    }


GLUCOSE = "Valor glucometria "


def _clean_vitals() -> dict[str, Column]:
    vitals = {
        c: invalid_to_normal(c, normal, lo, hi) for c, (_f, _l, _h, normal, lo, hi) in VITAL_RULES.items()
    }
    return vitals | {GLUCOSE: invalid_to_normal(GLUCOSE, GLUCOSE_NORMAL, *GLUCOSE_POSSIBLE)}


def _fisiologicas(**_: object) -> dict[str, Column]:
    abnormal = {f: outside(c, low, high) for c, (f, low, high, *_rest) in VITAL_RULES.items()}
    told = F.coalesce(col("Glucometría prequirúrgica ") == 1, F.lit(False))
    abnormal["flag_glucometria_anormal"] = flag(told | (outside(GLUCOSE, GLUCOSE_LOW, GLUCOSE_HIGH) == 1))
    return abnormal


def durations() -> dict[str, Column]:
    return {
        f"duracion_{who}_minutos": duration_minutes(f"Inicio {who} ", f"Fin {who} ")
        for who in ("cirujano", "anestesia")
    }


def _tiempos(df: DataFrame, **_: object) -> dict[str, Column]:
    """Durations above their own 90th percentile.

    Both percentiles come from one histogram of the stacked durations, held as a scalar subquery.
    """
    spans = durations()
    stacked = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("double").alias("v")) for n, c in spans.items()])).alias("x"))
    found = exact_quantiles(stacked.select("x.*"), "v", [0.9], by=["name"])
    limits = found.agg(F.struct(*[F.max(F.when(F.col("name") == n, F.col("q0"))).alias(n) for n in spans]).alias("p")).scalar()
    return {n.replace("duracion", "flag_duracion").replace("minutos", "larga"): flag(col(n) > limits[n]) for n in spans}


def _induccion(**_: object) -> dict[str, Column]:
    return {"flag_induccion_compleja": flag(_word("Clase de inducción ").isin("mixta"))}


def _via_aerea(**_: object) -> dict[str, Column]:
    return {
        "flag_intubacion_dificil": flag(_word("Intubación  ").isin("dificil", "imposible")),
        "flag_laringoscopia_alta": flag(to_number("Laringoscopia ") >= 3),
        "flag_tipo_intubacion_complejo": flag(
            _word("Tipo de intubación").isin("nasotraqueal", "otro", "traqueostomia")
        ),
        "flag_hoja_laringoscopio_recta": flag(_word("Hoja de laringoscopio ") == "recta"),
        "flag_elemento_via_aerea_complejo": flag(
            _word("Elemento de vía aérea utilizado ").isin("fibrolaringoscopio", "otro")
        ),
    }


def _ventilacion(**_: object) -> dict[str, Column]:
    def marked(name: str) -> Column:
        return F.coalesce(F.trim(col(name)) == "X", F.lit(False))

    rate = to_number("Frecuencia respiratoria ")
    return {
        "flag_ventilacion_asistida": flag(marked("Ventilación asistida ")),
        "flag_control_manual": flag(marked("Control manual ")),
        "flag_modos_avanzados": flag(marked("SIMV/PS") | marked("Presión soporte ")),
        "flag_frecuencia_resp_anormal": flag((rate > 0) & ((rate < 8) | (rate > 25))),
    }


def _tecnica(**_: object) -> dict[str, Column]:
    monitoring = F.lower(col("Monitoreo "))
    invasive = F.lit(False)
    for keyword in ("gases sanguineos", "pvc", "temperatura"):
        invasive = invasive | F.coalesce(monitoring.contains(keyword), F.lit(False))
    return {
        "flag_tecnica_combinada": flag(col("Técnica anestésica ").contains(",")),
        "flag_monitoreo_invasivo": flag(invasive),
    }


_VOLUMES = ("VOLUMEN LIQUIDOS ADMINISTRADOS", "Volumen de liquidos eliminados ", "Balance de líquidos ")


def _clean_volumes() -> dict[str, Column]:
    return {v: F.coalesce(to_number(v), F.lit(0.0)) for v in _VOLUMES}


def _liquidos(**_: object) -> dict[str, Column]:
    given, lost, balance = (col(v) for v in _VOLUMES)
    return {
        "flag_hemoderivados": flag(F.lower(col("Líquidos administrados ")).contains("hemoderivados")),
        "flag_aferesis": flag(
            F.lower(col("Liquidos eliminados")).rlike("aferesis|plaquetas|plasma|crioprecipitados")
        ),
        "flag_perdidas_altas": flag(lost > 1000),
        "flag_balance_extremo": flag((balance < -1000) | (balance > 2000)),
        "flag_volumen_alto": flag(given > 1000),
    }


def _desenlace(**_: object) -> dict[str, Column]:
    return {
        "flag_destino_uci": flag(_word("Destino final ").isin("uci", "otro")),
        "flag_intubado_salida": flag(_word("Estado intubación ") == "intubado"),
        "flag_complicacion": flag(F.trim(col("Complicaciones ")) == "X"),
    }


def _complicaciones(**_: object) -> dict[str, Column]:
    return {f: flag(col(c).isNotNull()) for f, c in COMPLICATIONS.items()}


STAY = "Estancia hospitalaria "


def _clean_stay() -> dict[str, Column]:
    days = F.when(col(STAY) == "amb", F.lit(0.0)).otherwise(F.coalesce(to_number(STAY), F.lit(0.0)))
    return {STAY: days}


def _estancia(stay_days: float = 3, **_: object) -> dict[str, Column]:
    return {
        "flag_hospitalizacion_no_anticipada": flag(_word("Hospitalización no anticipada") == "x"),
        "flag_uci_no_planeada": flag(col("Admisión a cuidado intensivo no planeada").isNotNull()),
        "flag_estancia_uci": flag(to_number("Estancia en UCI ") > 0),
        "flag_estancia_prolongada": flag(col(STAY) > stay_days),
    }


def _seguimiento(**_: object) -> dict[str, Column]:
    consult = _word("Necesidad de interconsultas a otras especialidades médicas")
    return {
        "flag_urgencias_30_dias": flag(col("Consulta a urgencias en los siguientes 30 días").isNotNull()),
        "flag_interconsultas": flag(consult == "x"),
    }


FAMILIES = (
    Family("flag_cancelacion", _cancelacion, ("_cancelada_medico",), drops=_CANCEL_TEXTS + ("_cancelada_medico",)),
    Family(
        "flag_reservas", _reservas, ("flag_reserva_hemoderivados", "flag_reserva_sangre"),
        drops=("Reserva de hemoderivados", "Reserva de sangre "),
    ),
    Family(
        "flag_fisiologicas", _fisiologicas,
        tuple(f for f, *_ in VITAL_RULES.values()) + ("flag_glucometria_anormal",), _clean_vitals,
    ),
    Family("flag_tiempos", _tiempos, ("flag_duracion_cirujano_larga", "flag_duracion_anestesia_larga"), durations),
    Family("flag_induccion", _induccion, ("flag_induccion_compleja",)),
    Family(
        "flag_via_aerea", _via_aerea,
        (
            "flag_intubacion_dificil", "flag_laringoscopia_alta", "flag_tipo_intubacion_complejo",
            "flag_hoja_laringoscopio_recta", "flag_elemento_via_aerea_complejo",
        ),
    ),
    Family(
        "flag_ventilacion", _ventilacion,
        (
            "flag_ventilacion_asistida", "flag_control_manual", "flag_modos_avanzados",
            "flag_frecuencia_resp_anormal",
        ),
    ),
    Family("flag_tecnica", _tecnica, ("flag_tecnica_combinada", "flag_monitoreo_invasivo")),
    # a high administered volume is recorded but does not enter the family flag
    Family(
        "flag_liquidos", _liquidos,
        ("flag_hemoderivados", "flag_aferesis", "flag_perdidas_altas", "flag_balance_extremo"), _clean_volumes,
    ),
    Family("flag_desenlace", _desenlace, ("flag_destino_uci", "flag_intubado_salida", "flag_complicacion")),
    Family("flag_complicaciones_medicas", _complicaciones, tuple(COMPLICATIONS)),
    # a long stay is recorded but does not enter the family flag
    Family(
        "flag_estancia", _estancia,
        ("flag_hospitalizacion_no_anticipada", "flag_uci_no_planeada", "flag_estancia_uci"), _clean_stay,
    ),
    # a consultation mark is recorded but does not enter the family flag
    Family("flag_seguimiento", _seguimiento, ("flag_urgencias_30_dias",)),
)
ALL_FLAGS = [f.flag for f in FAMILIES]


def flags_all(df: DataFrame, stay_days: float = 3, families: Sequence[str] | None = None) -> DataFrame:
    """Add every family whose flag is not in the frame yet (or only the named ones).

    Three stacked projections over one scan, whatever the number of families.
    """
    present = set(df.columns)
    todo = [f for f in FAMILIES if f.flag not in present and (families is None or f.flag in families)]
    if not todo:
        return df
    clean, parts, whole, drops = {}, {}, {}, []
    for family in todo:
        clean |= family.clean()
        parts |= family.parts(df=df, stay_days=stay_days)
        whole[family.flag] = any_flag(list(family.members))
        drops += family.drops
    if clean:
        df = df.withColumns(clean)
    return df.withColumns(parts).withColumns(whole).drop(*drops)
