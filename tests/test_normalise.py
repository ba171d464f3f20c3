from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stormledger import contract
from stormledger.functions import numbers, text
from stormledger.operators import fact, normalise


def legacy(spark, causes, **changes):
    row = {
        "DatGeracaoConjuntoDados": F.lit(None).cast("date"),
        "DscConjuntoUnidadeConsumidora": F.lit("X"),
        "DscAlimentadorSubestacao": F.lit("A1"),
        "DscSubestacaoDistribuicao": F.lit("  "),
        "NumOrdemInterrupcao": F.lit("1"),
        "DscTipoInterrupcao": F.lit("Não Programada"),
        "IdeMotivoInterrupcao": F.lit(0),
        "DatInicioInterrupcao": F.lit("2025-03-01 10:00:00").cast("timestamp_ntz"),
        "DatFimInterrupcao": F.lit("2025-03-01 10:30:30").cast("timestamp_ntz"),
        "NumNivelTensao": F.lit(13800),
        "NumUnidadeConsumidora": F.lit(10),
        "NumConsumidorConjunto": F.lit(1000),
        "NumAno": F.lit(2025),
        "NomAgenteRegulado": F.lit("DIST"),
        "SigAgente": F.lit(" DST "),
        "NumCPFCNPJ": F.lit(1),
        **changes,
    }
    base = spark.createDataFrame(
        [(i + 1, c) for i, c in enumerate(causes)],
        "IdeConjuntoUnidadeConsumidora long, DscFatoGeradorInterrupcao string",
    )
    return base.withColumns(row)


def current(spark, **changes):
    row = {
        name: F.lit(None).cast("string") for name in contract.CURRENT_COLUMNS
    } | {
        "SigAgente": F.lit("DST"),
        "CodMunicipioIBGE": F.lit("3106200"),
        "CodConjUnidadeConsumidora": F.lit("77"),
        "AnoCompetencia": F.lit("2026"),
        "CodAlimentador": F.lit(5),
        "DatInicioInterrupcao": F.lit("2026-01-01 00:00:00.5").cast("timestamp_ntz"),
        "DatFimInterrupcao": F.lit("2026-01-01 00:00:02.1").cast("timestamp_ntz"),
        "DscFatoGeradorOrigem": F.lit("Interno"),
        "DscFatoGeradorTipo": F.lit("Programada"),
        "DscFatoGeradorCausa": F.lit(" Meio ambiente"),
        "DscFatoGeradorDetalhe": F.lit("Maresia ou corrosão"),
        "DscMotivoExpurgo": F.lit(" "),
        "NumNivelTensao": F.lit(13800.5),
        "QtdConsumidoresAfetados": F.lit("2.5"),
        "QtdConsumidoresAtivos": F.lit("muitos"),
    }
    return spark.range(1).select(*[c.alias(n) for n, c in (row | changes).items()])


def test_layouts_are_told_apart():
    assert contract.detect_layout(contract.LEGACY_COLUMNS) == "legado"
    assert contract.detect_layout(contract.CURRENT_COLUMNS) == "atual"
    assert len(contract.LEGACY_COLUMNS) == 18 and len(contract.CURRENT_COLUMNS) == 26


@pytest.mark.parametrize("columns", [contract.LEGACY_COLUMNS, contract.CURRENT_COLUMNS])
def test_unknown_or_missing_column_stops_the_load(columns):
    with pytest.raises(ValueError, match="colunas novas.*DscCampoNovo"):
        contract.detect_layout(columns | {"DscCampoNovo"})
    with pytest.raises(ValueError, match="ausentes.*SigAgente"):
        contract.detect_layout(columns - {"SigAgente"})


@pytest.mark.parametrize(
    "cause, levels",
    [
        ("INTERNA - NAO PROGRAMADA - MEIO AMBIENTE - VENTO", "INTERNA|NAO PROGRAMADA|MEIO AMBIENTE|VENTO"),
        ("***INTERNA;NAO PROGRAMADA;MEIO AMBIENTE;VENTO", "INTERNA|NAO PROGRAMADA|MEIO AMBIENTE|VENTO"),
        ("Interna/Não programada/Meio ambiente/Vento", "INTERNA|NAO PROGRAMADA|MEIO AMBIENTE|VENTO"),
        (
            "INTERNA - NAO PROGRAMADA - PROPRIAS DO SISTEMA - ATUACAO DE SISTEMA - SEP",
            "INTERNA|NAO PROGRAMADA|PROPRIAS DO SISTEMA|ATUACAO DE SISTEMA - SEP",
        ),
        (
            "INTERNO - NAO PROGAMADA - MEIO AMBIENTE - QUEIMADA OU INCENDIO",
            "INTERNA|NAO PROGRAMADA|MEIO AMBIENTE|QUEIMA OU INCENDIO",
        ),
        ("EXTERNO - PROGRAMADA", "EXTERNA|PROGRAMADA|~|~"),
        (None, "~|~|~|~"),
    ],
)
def test_cause_text_becomes_four_levels(spark, cause, levels):
    row = normalise.normalise(legacy(spark, [cause])).first()
    got = [row.origem, row.tipo, row.causa, row.detalhe]
    assert "|".join(v if v is not None else "~" for v in got) == levels


def test_offsets_keep_seconds_and_flags(spark):
    out = normalise.normalise(legacy(spark, ["A - PROGRAMADA", "A - NAO PROGRAMADA", "A"]))
    assert out.schema.names == contract.FACT_COLUMNS
    assert out.drop().schema.simpleString() == contract.FACT_SCHEMA.simpleString()
    rows = out.orderBy("conjunto").collect()
    since = (datetime(2025, 3, 1, 10) - datetime(2017, 1, 1)).total_seconds()
    assert {(r.inicio_s, r.duracao_s) for r in rows} == {(since, 1830)}
    assert [r.programada for r in rows] == [True, False, None]
    assert rows[0].subestacao is None and rows[0].distribuidora == "DST"


def test_rows_without_start_go_and_nothing_else(spark):
    none = F.lit(None).cast("timestamp_ntz")
    assert normalise.normalise(legacy(spark, ["A"], DatInicioInterrupcao=none)).count() == 0
    kept = normalise.normalise(legacy(spark, ["A"], DatFimInterrupcao=none)).first()
    assert kept.duracao_s is None


def test_current_layout(spark):
    row = normalise.normalise(current(spark)).first()
    assert (row.ano, row.conjunto, row.municipio_ibge) == (2026, 77, 3106200)
    assert (row.origem, row.tipo, row.causa, row.detalhe) == (
        "INTERNA", "PROGRAMADA", "MEIO AMBIENTE", "CORROSAO",
    )
    assert row.programada is True and row.motivo_expurgo is None and row.alimentador == "5"
    # Text rounds half up, numbers half to even, words are no number.
    assert (row.consumidores_afetados, row.nivel_tensao, row.consumidores_conjunto) == (3, 13800, None)
    # The start rounds to even, the duration counts second boundaries.
    assert row.inicio_s % 60 == 0 and row.duracao_s == 2


def test_read_view(spark):
    stored = normalise.normalise(
        legacy(spark, ["A - B - C - VENTO", "A - B - C - OUTRA", "A - B - C"])
    )
    rows = fact.fact_view(stored).orderBy("conjunto").collect()
    assert [r.causa_climatica for r in rows] == [True, False, False]
    assert rows[0].inicio == datetime(2025, 3, 1, 10) and rows[0].fim == datetime(2025, 3, 1, 10, 30, 30)
    assert rows[0].duracao_min == 30.5


def test_years_union_by_name(spark):
    a = normalise.normalise(legacy(spark, ["A"])).drop("localizacao")
    both = normalise.union_years([a, normalise.normalise(current(spark))])
    assert both.count() == 2 and "localizacao" in both.columns


def test_integers_from_anything(spark):
    df = spark.createDataFrame(
        [("3.7", 2.5), ("2.5", 3.5), ("-2.5", -2.5), ("1e3", 3e10), ("x", float("nan")), (None, None)],
        "t string, d double",
    )
    rows = df.select(numbers.to_int(df, "t"), numbers.to_int(df, "d")).collect()
    assert [tuple(r) for r in rows] == [(4, 2), (3, 4), (-3, -2), (1000, None), (None, None), (None, None)]


def test_accents_of_all_kinds(spark):
    df = spark.createDataFrame([("Ação é ßtraße Ǻ á plain",)], "t string")
    row = df.select(text.strip_accents(F.col("t")), text.plain_upper(F.col("t"))).first()
    assert row[0] == "Acao e ßtraße A a plain"
    assert row[1] == "ACAO E ẞTRAẞE A A PLAIN"
