"""The five markets end to end on small raw tables in their own layouts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from holdfast.catalog.sales import synthetic_probability
from holdfast.operators.model import SearchGrid
from holdfast.operators.commit import read_published
from holdfast.plans.lists import export_month, last_list, quarantined, reload_lists
from holdfast.plans.markets import MARKETS
from holdfast.plans.monthly import (
    Inputs,
    forest_scorer,
    publish_month,
    run_month,
    source_lines,
    stored_scorer,
)
from holdfast.sources.feedback import NOTE_COLUMNS

AS_OF = dt.date(2024, 9, 15)  # a month below 10: the period text needs its zero


def months(n=30):
    y, m = 2024, 8
    for _ in range(n):
        yield dt.date(y, m, 1)
        y, m = (y, m - 1) if m > 1 else (y - 1, 12)


def lines(make, clients=30, products=("A", "B"), branches=("N", "S")):
    rng, rows = random.Random(3), []
    for client in range(clients):
        for product in products:
            for branch in branches:
                rate = rng.random()
                left = rng.random() < 0.3
                for i, month in enumerate(months()):
                    if (left and i < 3) or rng.random() > rate:
                        continue
                    day = month.replace(day=rng.randint(1, 28))
                    rows.append(make(client, product, branch, day, round(rng.uniform(10, 900), 2)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows)


def argentina(spark):
    def make(c, p, b, d, v):
        return dict(
            CODIGO=str(c), TIPOPRODSP2=p, CODPROD=901159 if p == "A" else 7, AGENCIA=f" {b} ",
            FECHA_COMP=dt.datetime.combine(d, dt.time(9)), PESOS=v, VOLUMEN=v / 10,
            CLIENTE=f"Name {c}", VENDEDOR="VENDEDOR DEPOT" if c == 1 else "V1", SEGMENTO="SEG",
            FORMADIST="OTHER" if p == "A" else "PACKAGED", GERENCIA_REGIONAL=" R1 ",
            GERENTE_NAC="old", CLIENTE_MAS="S" if c % 2 else "N", CORPORATIVO="N", BARRACAS="N",
            DISTRIBUIDORES="N", CC="1", FACTURACION="F", GERENCIA_NACIONAL="GN",
        )

    clients = frame(
        spark,
        [
            dict(
                CLIENT_CLI=c, NRODOC_CLI=str(c), TELEFO_CLI="1", EMAIL1_CLI="e", DOMICI_CLI="d",
                LOCALI_CLI="l", CODPOS_CLI="1", PROVIN_CLI="p", GRUPO__CLI="g",
                SGRUPO_CLI=" 002-ORGANISMOS PUBLICOS " if c == 2 else "ok",
            )
            for c in range(30)
        ],
    )
    tables = {
        "clients": clients,
        "managers": frame(spark, [dict(GERENCIA_REGIONAL="R1", GERENTE_NAC_MASTER="boss")]),
        "product_types": frame(
            spark, [dict(Codprod=str(c), TIPO="PRODUCTO GASEOSO") for c in (901159, 7)]
        ),
        "products": frame(spark, [dict(ARTID=7, MDDDSC="seven")]),
    }
    return Inputs(frame(spark, lines(make)), tables)


def bolivia(spark):
    def make(c, p, b, d, v):
        return dict(
            NO_CLIENTE=str(c), GRUPO_NSP=p, CENTROD=b, FECHA=dt.datetime.combine(d, dt.time()),
            TOTAL=v, VOLUMEN=1.0, NOMBRE=f"Name {c}", ASESOR_COMERCIAL="V", SEGMENTO="S",
            GRUPO_ICC=None if c % 2 else "CO2", GRUPO=1, TIPO_CLIENTE="PV", TELEFONO="1",
            EMAIL1="e", DIRECCION="d", ZONA="z", PAIS="p", PROVINCIA="p", CANTON="c",
            DISTRITO="d", BARRIO="b", DESCRIPCION_1="x",
        )

    rows = lines(make)
    return Inputs(frame(spark, rows + rows[:40]))  # repeated lines are dropped


def chile(spark):
    def make(c, p, b, d, v):
        return {
            "cliente": c, "sucursal_documento": b, "sucursal": b,
            "Fecha_Emision": d.strftime(" %d/%m/%Y "), "Total_moneda": v * 1e5, "Total_USD": v,
            "cantidad_producto": 2.0, "Nombre_cliente": f"Name {c}", "GPH_Super": p,
            "isic": "1", "nombre_isic": "one", "Tipo_datos": "IMPUESTOS" if c == 3 else "VENTA",
            "tipo_documento": "F", "nombre_clase_cliente": "CLASS", "telefono_legal": "1",
            "cuin": "2", "E_mail_legal": "e", "sucursal_emitente": "s", "sucursal_cliente": "s",
            "Codigo_postal": "1", "localidad_legal": "l", "localidad_dom": "l",
        }

    classes = frame(
        spark,
        [
            {
                "GPH_Super": p, "Prod_Family_level3": f"L3{p}", "Prod_Family": "F",
                "Prod_Family_level2": "L2", "GPH_Group_0_name": "PG&P",
                "Tipo_gas_2": "Sales of Goods", "sub_business_area": "X",
            }
            for p in "AB"
        ],
    )
    tables = {
        "product_classes": classes,
        "business_units": frame(
            spark, [dict(isic="1", nombre_isic="one", Market_Segment="RETAIL")]
        ),
        "margins": frame(spark, [{"Prod_Family_level3": f"L3{p}", "N": 0.4, "S": 0.2} for p in "AB"]),
        "sellers": frame(spark, [dict(client_id=c, seller=f"V{c % 3}") for c in range(20)]),
        "centre_clients": frame(spark, [dict(client_id=c) for c in range(0, 30, 2)]),
    }
    return Inputs(frame(spark, lines(make)), tables, agents={"one": 0.3, "two": 0.7})


def peru(spark):
    def make(c, p, b, d, v):
        return {
            "CodigoClienteFull": str(c), "Producto_SPGrupo_descripcion": p,
            "sucursal_descripcion": b, "venta_tiempo_id": int(d.strftime("%Y%m%d")),
            "Venta en S/": v, "Venta en Volumen": 1.0, "cliente_descripcion": f"Name {c}",
            "clt_vendedor_descripcion": "V", "producto_packaged": 1, "venta_servicio": 0,
            "venta_flete": 0, "Producto": f"item {p}", "Cliente_Aplicacion": "app",
            "Cliente_Industria": "ind", "Ubigeo_Legal": "u", "Ubigeo_Entrega": "u",
            "cliente_ruc_dni": "DNI5" if c == 4 else "205",
        }

    remap = frame(
        spark,
        [
            {
                "Producto": "item A", "Producto_SPGrupo_descripcion": "A",
                "Producto_SPGrupo_descripcion_new": "A new",
            }
        ]
        * 2,
    )
    return Inputs(frame(spark, lines(make)), {"product_map": remap})


def paraguay(spark):
    def make(c, p, b, d, v):
        return {
            "NO_CLIENTE": c, "TIPO_DATOS": "ArgÃ³n" if p == "A" else p, "CENTRO": b,
            "FECHA_FACTURA": dt.datetime.combine(d, dt.time()),
            "FECHA": dt.datetime.combine(d, dt.time()), "PERIODO": d.strftime("%m/%Y"),
            "VTA_RECONOCIDA": v, "VOLUMEN_FACTURADO": 1.0, "NOMBRE": f"Name {c}", "VENDEDOR": "V",
            "SUBSTR(VM.TIPO_CLIENTE,1,2)": 1, "SUBSTR(VM.TIPO_CLIENTE,4,15)": "CLIENT",
            "FAMILIA": "GASES", "SECTOR": "S", "NOMBRE_PRODUCTO": p, "TELEFONO": "1",
            "EMAIL1": "e", "PROVINCIA": "p", "LOCALIDAD": "l",
        }

    remap = frame(spark, [dict(NOMBRE_PRODUCTO="Z", TIPO_DATOS="Z", TIPO_DATOS_NEW="ZZ")])
    rows = lines(make)
    for row in rows:
        if row["TIPO_DATOS"] == "B":
            row["NOMBRE_PRODUCTO"] = "Z"  # renamed by the map
    return Inputs(frame(spark, rows), {"product_map": remap})


MAKERS = {"ar": argentina, "bo": bolivia, "cl": chile, "pe": peru, "py": paraguay}


def hash_scorer(training, production):
    return production.withColumn("churn_probability", synthetic_probability()), None


@pytest.fixture(scope="module")
def results(spark):
    return {
        code: run_month(MARKETS[code], make(spark), AS_OF, hash_scorer)
        for code, make in MAKERS.items()
    }


@pytest.mark.parametrize("code", MAKERS)
def test_run(results, code):
    found = results[code]
    clients, detail = found.client_list.toPandas(), found.product_risk.toPandas()
    assert len(clients) and len(detail)
    assert set(clients.period) == {"202408"} and set(clients.country) == {code}
    assert not clients.duplicated(["client_id", "branch"]).any()
    assert not detail.duplicated(["client_id", "product", "branch"]).any()
    assert set(detail.client_id) == set(clients.client_id)
    assert detail.buy_probability.between(0, 100).all()
    assert sorted(clients.call_rank) == list(range(1, len(clients) + 1))
    loss = clients.sort_values("call_rank").expected_loss.tolist()
    assert loss == sorted(loss, reverse=True)
    assert (clients[list(NOTE_COLUMNS)] == "").all(axis=None)  # a first run has blank notes
    assert set(clients[MARKETS[code].period_column]) == {"202408"}
    view = found.risk_view
    assert view.count() == view.select("client_id", "product", "branch").distinct().count()
    history = found.history_view.agg(F.min("sale_period"), F.max("sale_period")).first()
    assert history[0] == history[1] == dt.date(2024, 8, 1)


def test_argentina_rules(results):
    clients = results["ar"].client_list.toPandas()
    assert 1 not in set(clients.client_id)  # excluded seller
    assert 2 not in set(clients.client_id)  # excluded public body, trimmed before the test
    assert set(results["ar"].product_risk.toPandas()["product"]) == {"ARGON GASEOSO", "B"}
    assert set(clients.branch.dropna()) == {"N", "S"}
    history = results["ar"].history_view
    assert history.select("GERENTE_NAC").distinct().collect()[0][0] == "boss"


def test_chile_rules(results):
    clients = results["cl"].client_list.toPandas().set_index(["client_id", "branch"])
    assert set(clients.assignee) <= {"one", "two", "V0", "V1", "V2", "Sin Vendedor Asignado"}
    for (client, _), row in clients.iterrows():
        assert (client % 2 == 0) == (row.assignee in ("one", "two"))
    assert clients.groupby("client_id").assignee.nunique().max() == 1
    taxed = clients[clients.index.get_level_values(0) == 3]
    assert taxed.sales_12m.isna().all()  # tax lines are not sales
    assert "E_mail_legal" not in results["cl"].history_view.columns
    assert "segment" in results["cl"].history_view.columns


def test_peru_and_paraguay_labels(results):
    peru, paraguay = results["pe"].product_risk.toPandas(), results["py"].product_risk.toPandas()
    assert set(peru["product"]) == {"A new", "B"} and 4 not in set(peru.client_id)
    assert set(paraguay["product"]) == {"Argon", "ZZ"}  # a renamed product has its score
    scored = paraguay[paraguay["product"] == "ZZ"].churn_probability
    assert scored.notna().any()


def test_window_bounds(spark):
    days = [dt.date(2022, 6, 1), dt.date(2022, 6, 2), dt.date(2022, 6, 30), dt.date(2022, 7, 1)]
    keys = spark.createDataFrame([(int(d.strftime("%Y%m%d")), d) for d in days], "k int, d date")

    def first(code, column, value):
        frame = keys.withColumn(column, value)
        return source_lines(MARKETS[code], frame, AS_OF).agg(F.min("d")).first()[0]

    assert first("ar", "FECHA_COMP", F.col("d").cast("timestamp")) == days[0]
    assert first("cl", "Fecha_Emision", F.date_format("d", "dd/MM/yyyy")) == days[3]
    assert first("pe", "venta_tiempo_id", F.col("k")) == days[1]


def test_publish_export_and_reload(spark, results, tmp_path):
    root, out = str(tmp_path / "results"), str(tmp_path / "export")
    for code in ("ar", "pe"):
        for _ in range(2):
            publish_month(MARKETS[code], results[code], root)
    stored = read_published(spark, root, "client_list")
    want = results["ar"].client_list.count() + results["pe"].client_list.count()
    assert stored.count() == want
    export_month(spark, root, out, "202408")
    banded = spark.read.option("header", "true").csv(f"{out}/clients")
    assert banded.count() == want
    assert {r[0] for r in banded.select("band").distinct().collect()} <= {
        "Risk", "Opportunity", "Out",
    }
    assert {r[0] for r in banded.select("country").distinct().collect()} == {"ar", "pe"}

    # The exported files come back as they are, with one row edited by hand.
    edited = tmp_path / "edited" / "country=ar"
    edited.mkdir(parents=True)
    exported = spark.read.option("header", "true").option("emptyValue", "").csv(
        f"{out}/clients/country=ar"
    ).toPandas()
    chosen = exported.client_id.iloc[0]
    exported.loc[exported.client_id == chosen, "Estado"] = "Llamado"
    exported.loc[exported.client_id == chosen, "observaciones"] = "dos, tres"
    exported.to_csv(edited / "list.csv", index=False)
    assert reload_lists(spark, str(tmp_path / "edited"), str(tmp_path / "back")).count() == 0
    old = last_list(spark, str(tmp_path / "back"), "ar")
    assert old.count() == len(exported)
    again = run_month(MARKETS["ar"], Inputs(*_with(argentina(spark), old)), AS_OF, hash_scorer)
    rows = again.client_list.toPandas()
    mine = rows.client_id == int(chosen)
    assert set(rows[mine].observaciones) == {"dos, tres"} and set(rows[~mine].Estado) == {""}
    (edited / "list.csv").write_text("client_id,Estado\n1,x\n")
    assert reload_lists(spark, str(tmp_path / "edited"), str(tmp_path / "back")).count() == 0
    assert "row_no" in quarantined(spark, str(tmp_path / "back")).first()["reason"]
    assert last_list(spark, str(tmp_path / "back"), "ar").count() == len(exported)  # as it was

    # An edited list comes back: a good row, a bad line, and another country untouched by it.
    client = results["ar"].client_list.first()["client_id"]
    header = ",".join(["client_id", "row_no", *NOTE_COLUMNS])
    for country, line in {"ar": f"{client},1,Visitado" + ',"x"' * 9, "pe": "oops,1" + ",x" * 10}.items():
        folder = tmp_path / "drop" / f"country={country}"
        folder.mkdir(parents=True)
        (folder / "list.csv").write_text(f"{header}\n{line}\n")
    bad = reload_lists(spark, str(tmp_path / "drop"), str(tmp_path / "last"))
    assert [r["country"] for r in bad.collect()] == ["pe"]
    assert bad.count() == 1 and bad.select("country").count() == 1
    old = last_list(spark, str(tmp_path / "last"), "ar")
    again = run_month(MARKETS["ar"], Inputs(*_with(argentina(spark), old)), AS_OF, hash_scorer)
    rows = again.client_list.toPandas()
    assert set(rows[rows.client_id == client].Estado) == {"Visitado"}
    assert set(rows[rows.client_id != client].Estado) == {""}


def _with(inputs, old):
    return inputs.sales, inputs.tables, old


def test_forest_run_and_reuse(spark, tmp_path):
    spec, path = MARKETS["bo"], str(tmp_path / "model")
    grid = SearchGrid(trees=(10,), depths=(4, 6), leaf_rows=(1,), draws=2, folds=2, rungs=2)
    inputs = bolivia(spark)
    found = run_month(spec, inputs, AS_OF, forest_scorer(spec, grid, path))
    report = found.metrics.toPandas()
    assert list(report["class"]) == [
        "0", "1", "accuracy", "macro avg", "weighted avg", "AUC", "Churn Rate", "Score AUC",
    ]
    assert set(report.country_name) == {spec.country}
    first = found.product_risk.toPandas()
    again = run_month(spec, inputs, AS_OF, stored_scorer(path)).product_risk.toPandas()
    keys = ["client_id", "product", "branch"]
    assert first.sort_values(keys).churn_probability.round(9).fillna(-1).tolist() == (
        again.sort_values(keys).churn_probability.round(9).fillna(-1).tolist()
    )
    assert first.churn_probability.dropna().between(0, 1).all()
