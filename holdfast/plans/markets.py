"""The five markets with a pipeline.

Fixed values: raw column names, codes and category texts must equal those of the markets'
tables, so they are written out here as they are stored.
"""

from __future__ import annotations

from holdfast.spec import (
    KEYS,
    NUMERIC_FEATURES,
    CodeOverride,
    Lookup,
    MarketSpec,
    Remap,
    Rule,
    Windows,
)

CLIENT_BRANCH = ("client_id", "branch")
WITH_MEAN_GAP = (*NUMERIC_FEATURES, "mean_gap")

COUNTRIES = {
    "cl": "Chile",
    "uy": "Uruguay",
    "ar": "Argentina",
    "pe": "Peru",
    "py": "Paraguay",
    "bo": "Bolivia",
}

ARGENTINA = MarketSpec(
    code="ar",
    country=COUNTRIES["ar"],
    columns={
        "client_id": "CODIGO",
        "product": "TIPOPRODSP2",
        "product_code": "CODPROD",
        "branch": "AGENCIA",
        "sale_date": "FECHA_COMP",
        "amount": "PESOS",
        "volume": "VOLUMEN",
        "client_name": "CLIENTE",
        "seller": "VENDEDOR",
        "segment": "SEGMENTO",
    },
    trimmed=("branch", "GERENCIA_REGIONAL"),
    long_ids=("client_id", "product_code"),
    overrides=(
        CodeOverride("product", "product_code", (103201, 1103201), "ARGON LIQ. EN TERMOS"),
        CodeOverride("product", "product_code", (901273,), "NITROGENO GASEOSO"),
        CodeOverride("product", "product_code", (901270,), "HELIO ANALITICO"),
        CodeOverride("product", "product_code", (901159, 901272), "ARGON GASEOSO"),
        CodeOverride(
            "FORMADIST",
            "product_code",
            (901159, 1901159, 2901159, 901272, 1901272, 2901272),
            "PACKAGED",
        ),
    ),
    raw_rules=(
        Rule("FORMADIST", "in", ("PACKAGED", "CO2 GASEOSO", "HIELO SECO")),
        Rule("product", "not_in", ("HOME CARE",)),
    ),
    lookups=(
        Lookup("clients", (("client_id", "CLIENT_CLI"),), {}, rest=True),
        Lookup(
            "managers",
            (("GERENCIA_REGIONAL", "GERENCIA_REGIONAL"),),
            {"GERENTE_NAC": "GERENTE_NAC_MASTER"},
        ),
        Lookup("product_types", (("product_code", "Codprod"),), {"TABLA_TIPO": "TIPO"}),
        Lookup("products", (("product_code", "ARTID"),), {"MDDDSC": "MDDDSC"}),
    ),
    scope_trimmed=("SGRUPO_CLI",),
    scope_rules=(
        Rule("product", "not_null"),
        Rule(
            "TABLA_TIPO",
            "in",
            ("PRODUCTO GASEOSO", "PRODUCTO CO2", "PRODUCTO OTROS", "PRODUCTO GE"),
        ),
        Rule(
            "SGRUPO_CLI",
            "not_in",
            (
                "004-MUNICIPALIDADES/GOBERNACIONES",
                "010-PROVINCIALES Y MUNICIPALES",
                "007-HOMECARE ESTATAL",
                "002-HOSPITALES PUBLICOS",
                "002-ORGANISMOS PUBLICOS",
            ),
        ),
        Rule("segment", "not_in", ("COMPETIDORES",)),
    ),
    attribute_keys=("client_id", "product"),
    attributes=("segment", "CLIENTE_MAS", "CORPORATIVO", "BARRACAS", "DISTRIBUIDORES"),
    flags=("CLIENTE_MAS", "CORPORATIVO", "BARRACAS", "DISTRIBUIDORES"),
    numeric=(*NUMERIC_FEATURES, "CLIENTE_MAS", "CORPORATIVO", "BARRACAS", "DISTRIBUIDORES"),
    list_columns=(
        "segment",
        "CC",
        "FACTURACION",
        "CLIENTE_MAS",
        "CORPORATIVO",
        "BARRACAS",
        "DISTRIBUIDORES",
    ),
    contact_columns=("NRODOC_CLI", "TELEFO_CLI", "EMAIL1_CLI"),
    views=(
        (
            KEYS,
            (
                "GERENCIA_NACIONAL",
                "GERENCIA_REGIONAL",
                "DOMICI_CLI",
                "LOCALI_CLI",
                "CODPOS_CLI",
                "PROVIN_CLI",
                "GRUPO__CLI",
                "SGRUPO_CLI",
                "FORMADIST",
                "TABLA_TIPO",
                "seller",
            ),
        ),
    ),
    excluded_sellers=("VENDEDOR DEPOT",),
)

BOLIVIA = MarketSpec(
    code="bo",
    country=COUNTRIES["bo"],
    columns={
        "client_id": "NO_CLIENTE",
        "product": "GRUPO_NSP",
        "branch": "CENTROD",
        "sale_date": "FECHA",
        "amount": "TOTAL",
        "volume": "VOLUMEN",
        "client_name": "NOMBRE",
        "seller": "ASESOR_COMERCIAL",
        "segment": "SEGMENTO",
    },
    scope_rules=(
        Rule("GRUPO_ICC", "in_or_null", ("PACKAGED MEDICINAL", "PACKAGED INDUSTRIAL", "CO2")),
        Rule("product", "not_in", ("Liquid Helium Medical", "Liquid CO2")),
        Rule("GRUPO", "not_in", (2, 3)),
        Rule("TIPO_CLIENTE", "in", ("PV",)),
        Rule("segment", "not_in", ("HOME CARE", "HOMECARE")),
    ),
    drop_duplicate_lines=True,
    attributes=("TIPO_CLIENTE", "segment"),
    numeric=WITH_MEAN_GAP,
    list_columns=("TIPO_CLIENTE", "segment", "TELEFONO", "EMAIL1", "seller"),
    seller_from="branch",
    views=(
        (
            KEYS,
            (
                "GRUPO",
                "TIPO_CLIENTE",
                "DIRECCION",
                "ZONA",
                "PAIS",
                "PROVINCIA",
                "CANTON",
                "DISTRITO",
                "BARRIO",
                "DESCRIPCION_1",
                "seller",
                "segment",
            ),
        ),
    ),
    opportunity_cut_scoped=False,
)

CHILE = MarketSpec(
    code="cl",
    country=COUNTRIES["cl"],
    columns={
        "client_id": "cliente",
        "branch": "sucursal_documento",
        "sale_date": "Fecha_Emision",
        "amount": "Total_moneda",
        "amount_usd": "Total_USD",
        "volume": "cantidad_producto",
        "client_name": "Nombre_cliente",
    },
    date_pattern="dd/MM/yyyy",
    measures={"monetary_value_usd": "amount_usd", "monetary_value": "amount"},
    lookups=(
        Lookup(
            "product_classes",
            (("GPH_Super", "GPH_Super"),),
            {"product": "Prod_Family_level3"},
            at="scope",
            rest=True,
        ),
        Lookup(
            "business_units",
            (("isic", "isic"), ("nombre_isic", "nombre_isic")),
            {"segment": "Market_Segment"},
            at="scope",
            rest=True,
        ),
    ),
    scope_rules=(
        Rule("GPH_Group_0_name", "in", ("PG&P",)),
        Rule("Tipo_gas_2", "in", ("Sales of Goods",)),
        Rule("nombre_clase_cliente", "not_in", ("GOVERMENT CUSTOMERS",)),
        Rule("sub_business_area", "not_in", ("HC",)),
        Rule("segment", "not_in", ("GAS COMPETITOR", "INTERCOMPANY")),
    ),
    list_branch="sucursal",
    sales_total_rules=(
        Rule("Tipo_datos", "not_in", ("IMPUESTOS",)),
        Rule("tipo_documento", "not_in", ("D", "FAXE")),
    ),
    attribute_keys=("client_id", "product"),
    attributes=("segment", "nombre_clase_cliente", "Prod_Family", "Prod_Family_level2"),
    required_attributes=("segment",),
    attributes_scoped=True,
    categories=("product", "Prod_Family_level2", "Prod_Family", "nombre_clase_cliente", "segment"),
    numeric=("monetary_value_usd", *WITH_MEAN_GAP),
    list_columns=("segment", "telefono_legal", "cuin", "E_mail_legal"),
    list_scoped=True,
    seller_from="table",
    margin_table=True,
    views=(
        (
            CLIENT_BRANCH,
            (
                "GPH_Group_0_name",
                "sucursal_emitente",
                "sucursal_cliente",
                "Tipo_gas_2",
                "telefono_legal",
                "Codigo_postal",
                "localidad_legal",
                "localidad_dom",
            ),
        ),
    ),
    history_lookups=("product_classes",),
    history_segment=True,
    history_drop=("E_mail_legal",),
    excluded_sellers=("VENDEDOR DEPOT",),
    seller_limit=3500000.0,
    call_centre=True,
    period_column="periodo",
    windows=Windows(history=26),  # its first month is not part of the window
)

PERU = MarketSpec(
    code="pe",
    country=COUNTRIES["pe"],
    columns={
        "client_id": "CodigoClienteFull",
        "product": "Producto_SPGrupo_descripcion",
        "branch": "sucursal_descripcion",
        "sale_date": "venta_tiempo_id",
        "amount": "Venta en S/",
        "volume": "Venta en Volumen",
        "client_name": "cliente_descripcion",
        "seller": "clt_vendedor_descripcion",
    },
    date_pattern="yyyyMMdd",
    history_after=True,
    id_class=("tipo_id", "cliente_ruc_dni", "DNI", "DNI", "RUC"),
    scope_rules=(
        Rule("producto_packaged", "in", (1,)),
        Rule("venta_servicio", "not_in", (1,)),
        Rule("venta_flete", "not_in", (1,)),
        Rule(
            "Producto",
            "not_in",
            (
                "Oxigeno Medicinal 99.5% V/v Liquido Criogénico",
                "Nitrogeno Liquido",
                "Oxigeno Liquido Industrial",
                "Oxido Nitroso 99.0% V/v Gas Licuado",
            ),
        ),
        Rule("Cliente_Aplicacion", "not_in", ("Home Care/ Atencion Domicilio",)),
    ),
    remap=Remap(
        "product_map", ("Producto", "Producto"), "product", "Producto_SPGrupo_descripcion_new"
    ),
    remap_rules=(Rule("tipo_id", "in", ("RUC",)),),
    sales_total_scoped=True,
    attributes=(),
    categories=("branch", "product"),
    numeric=WITH_MEAN_GAP,
    list_columns=("cliente_ruc_dni", "seller", "Cliente_Industria", "Cliente_Aplicacion"),
    seller_from="branch",
    views=(
        (CLIENT_BRANCH, ("seller", "Ubigeo_Legal", "Ubigeo_Entrega", "Cliente_Industria")),
        (KEYS, ("Cliente_Aplicacion",)),
    ),
    history_rules=(
        Rule("producto_packaged", "in", (1,)),
        Rule("venta_servicio", "not_in", (1,)),
        Rule("venta_flete", "not_in", (1,)),
    ),
    history_drop=("tipo_id",),
    newest_only=("client_list", "product_risk"),
)

PARAGUAY = MarketSpec(
    code="py",
    country=COUNTRIES["py"],
    columns={
        "client_id": "NO_CLIENTE",
        "product": "TIPO_DATOS",
        "branch": "CENTRO",
        "sale_date": "FECHA_FACTURA",
        "history_date": "FECHA",
        "period_raw": "PERIODO",
        "amount": "VTA_RECONOCIDA",
        "volume": "VOLUMEN_FACTURADO",
        "client_name": "NOMBRE",
        "seller": "VENDEDOR",
        "TIPO_CLIENTE": "SUBSTR(VM.TIPO_CLIENTE,1,2)",
        "TIPO_CLIENTE_2": "SUBSTR(VM.TIPO_CLIENTE,4,15)",
    },
    period_from=("period_raw", "MM/yyyy"),
    text_repairs={
        "product": {
            "CO2 LÃ\xadquido": "CO2 Liquido",
            "MercaderÃ\xadas": "Mercaderias",
            "NitrÃ³geno Gaseoso": "Nitrogeno Gaseoso",
            "ArgÃ³n": "Argon",
            "NitrÃ³geno LÃ\xadquido": "Nitrogeno Liquido",
        }
    },
    scope_rules=(
        Rule("FAMILIA", "in", ("GASES", "CO2 NO USAR")),
        Rule("TIPO_CLIENTE_2", "not_in", ("HOME CARE",)),
        Rule(
            "product",
            "not_in",
            ("CO2 Liquido", "Nitrogeno Liquido", "OXIGENO LIQUIDO (COMPET.)", "Mercaderias"),
        ),
    ),
    remap=Remap("product_map", ("NOMBRE_PRODUCTO", "NOMBRE_PRODUCTO"), "product", "TIPO_DATOS_NEW"),
    history_date="history_date",
    history_drop=("period_raw",),
    attributes=("TIPO_CLIENTE", "TIPO_CLIENTE_2", "SECTOR", "FAMILIA"),
    attributes_remapped=True,
    categories=("product", "TIPO_CLIENTE_2", "SECTOR", "FAMILIA"),
    numeric=WITH_MEAN_GAP,
    list_columns=("TIPO_CLIENTE", "TIPO_CLIENTE_2", "SECTOR", "TELEFONO", "EMAIL1", "seller"),
    seller_from="branch",
    views=((KEYS, ("SECTOR", "FAMILIA", "PROVINCIA", "LOCALIDAD", "seller")),),
    opportunity_cut_scoped=False,
)

MARKETS = {m.code: m for m in (ARGENTINA, BOLIVIA, CHILE, PERU, PARAGUAY)}
