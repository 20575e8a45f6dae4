"""Schemas and fixed vocabularies. All raw columns are strings, named by position."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


#: The registry's files, column by column.
COMPANY = strings("cnpj_basico razao_social natureza_juridica qualificacao_responsavel capital_social porte ente_federativo")
ESTABLISHMENT = strings(
    "cnpj_basico cnpj_ordem cnpj_dv identificador_matriz_filial nome_fantasia situacao_cadastral data_situacao_cadastral motivo_situacao_cadastral"
    " nome_cidade_exterior pais data_inicio_atividade cnae_fiscal_principal cnae_fiscal_secundaria tipo_logradouro logradouro numero complemento bairro"
    " cep uf municipio ddd1 telefone1 ddd2 telefone2 ddd_fax fax correio_eletronico situacao_especial data_situacao_especial"
)
LOOKUP = strings("codigo descricao")
#: The enriched table's columns, in order.
POI = strings(
    "cnpj cnpj_basico razao_social nome_fantasia natureza_juridica natureza_juridica_descricao porte capital_social cnae_fiscal_principal"
    " cnae_fiscal_principal_descricao cnae_fiscal_secundaria osm_category identificador_matriz_filial situacao_cadastral data_situacao_cadastral"
    " data_inicio_atividade tipo_logradouro logradouro numero complemento bairro cep municipio municipio_descricao uf ddd1 telefone1 ddd2 telefone2 correio_eletronico"
)
_POINT = [T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]
GEOCODED = T.StructType([*POI.fields, *_POINT, T.StructField("geo_precision", T.StringType())])
INDEX = T.StructType([*strings("cep_norm num_norm housenumber_raw street_norm street_raw city_norm suburb_norm suburb_raw").fields, *_POINT])
KEY_CACHE = T.StructType([T.StructField("cep", T.StringType()), *_POINT])
PROGRESS = T.StructType([T.StructField("cnpj", T.StringType()), *_POINT, T.StructField("geo_precision", T.StringType())])

#: The registry's codes.
ACTIVE, EXCLUDED_SIZE, EXCLUDED_NATURE = "02", "05", "2135"
#: How a coordinate was found.
CEP, NONE, CENTROID, PENDING = "cep", "none", "municipio_centroid", "pending"
L1, L2, L3, L4 = "apt_cep_num_street", "apt_cep_num", "apt_street_exact", "apt_fuzzy"
LAYERS = (L1, L2, L3, L4)
#: Labels of a structured geocoder's result types.
RESULT_LABELS = {
    "Point Address": "tomtom_point_address",
    "Address Range": "tomtom_address_range",
    "Street": "tomtom_street",
    "Cross Street": "tomtom_cross_street",
    "Geography": "tomtom_geography",
}
UNKNOWN_LABEL = "tomtom_unknown"
#: The reports' columns.
VALIDATION = "cnpj razao_social uf municipio_descricao bairro tipo_logradouro logradouro numero complemento cep geo_precision apt_lat apt_lon tt_lat tt_lon tt_score tt_type distance_m tt_error".split()
RESAMPLE = "cnpj razao_social uf municipio_descricao bairro tipo_logradouro logradouro numero cep old_precision old_apt_lat old_apt_lon old_distance_m new_precision new_apt_lat new_apt_lon new_distance_m tt_lat tt_lon delta_m".split()
