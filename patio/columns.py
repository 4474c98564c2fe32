"""Column roles and fixed values of the listings data model."""

from pyspark.sql import types as T

ID = "id"
ENTITY = "marca_modelo"
YEAR = "ano_fabricacao"
PRICE = "preco_brl"
DATE = "data_anuncio"
FUEL = "combustivel"
STATUS = "status"
BRAND = "marca"

# Status and fuel domains of the data model.
SOLD = "Vendido"
AVAILABLE = "Disponível"
RESERVED = "Reservado"
UNKNOWN_STATUS = "Desconhecido"
UNKNOWN_ENTITY = "Desconhecido"
UNKNOWN_FUEL = "Não Informado"
FUELS = ["Gasolina", "Flex", "Diesel", "Elétrico", "Híbrido"]
STATUSES = [AVAILABLE, SOLD, RESERVED]

# Ordinal codes used when categories enter a correlation.
FUEL_CODES = {
    "Não Informado": 0, "Gasolina": 1, "Flex": 2, "Diesel": 3, "Híbrido": 4, "Elétrico": 5,
}
STATUS_CODES = {"Desconhecido": 0, "Disponível": 1, "Reservado": 2, "Vendido": 3}

# Spellings merged after title-casing.
FUEL_SYNONYMS = {"Eletrico": "Elétrico", "Electrico": "Elétrico"}
STATUS_SYNONYMS = {"Disponivel": "Disponível"}

# Price band labels and default upper cuts.
BAND_LABELS = ["1_Econômico", "2_Intermediário", "3_Premium", "4_Luxo"]
BAND_CUTS = [50_000, 90_000, 130_000]

LISTINGS_SCHEMA = T.StructType([
    T.StructField(ID, T.LongType(), False),
    T.StructField(ENTITY, T.StringType(), False),
    T.StructField(YEAR, T.IntegerType(), False),
    T.StructField(PRICE, T.DoubleType(), False),
    T.StructField(DATE, T.DateType(), False),
    T.StructField(FUEL, T.StringType(), False),
    T.StructField(STATUS, T.StringType(), False),
])
RAW_COLUMNS = [ID, ENTITY, YEAR, PRICE, DATE, FUEL, STATUS]
