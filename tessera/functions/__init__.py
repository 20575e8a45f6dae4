from .geo import haversine_m, within
from .similarity import jaro_winkler, jaro_winkler_score
from .text import cep_key, cep_key_strict, compose_id, digits, fold, index_city, index_number, index_street, poi_city, poi_district, poi_number, poi_street, suburb_clean

__all__ = [
    "cep_key", "cep_key_strict", "compose_id", "digits", "fold", "haversine_m", "index_city", "index_number", "index_street", "jaro_winkler",
    "jaro_winkler_score", "poi_city", "poi_district", "poi_number", "poi_street", "suburb_clean", "within",
]
