"""What the environmental domain fixes: parameters, limits, contracts and vocabularies.

Operators take these as arguments, so the same code runs on any table with a
contract of its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Code, name and unit of each parameter.
PARAMETERS = [
    ("TEMP_AGUA", "Temperatura da agua", "Celsius"),
    ("TEMP_AR", "Temperatura do ar", "Celsius"),
    ("PH", "Potencial hidrogenionico", "pH"),
    ("OD", "Oxigenio dissolvido", "mg/L"),
    ("COND_ELETRICA", "Condutividade eletrica", "uS/cm"),
    ("TURBIDEZ", "Turbidez da agua", "NTU"),
    ("UMIDADE", "Umidade relativa do ar", "%"),
    ("CHUVA", "Precipitacao", "mm"),
    ("VENTO", "Velocidade do vento", "km/h"),
    ("CONDICAO_METEO", "Condicao meteorologica", "descricao"),
]
UNKNOWN_UNIT = "desconhecida"

# The inclusive limits of each parameter (None: no limit on that side).
LIMITS = {
    "TEMP_AGUA": (0.0, 50.0),
    "PH": (0.0, 14.0),
    "OD": (0.0, None),
    "COND_ELETRICA": (0.0, None),
    "TURBIDEZ": (0.0, None),
    "TEMP_AR": (-50.0, 60.0),
    "UMIDADE": (0.0, 100.0),
    "CHUVA": (0.0, None),
    "VENTO": (0.0, None),
}

# Personal data that the tables hold, for the catalogue of the data protection law.
PERSONAL_DATA = [
    ("dbo", "operadores", "cpf", "cpf_hash", "Dado pessoal", "Cadastro e identificacao de operadores de campo", "HMAC-SHA-256", "Chave HMAC restrita ao processo autorizado; digest nao reversivel"),
    ("dbo", "operadores", "nome_completo", "nome_completo_cifrado", "Dado pessoal", "Cadastro e identificacao de operadores de campo", "Fernet", "Descriptografia autorizada por principal; tentativas auditadas sem PII"),
]

# Names of cities, as keys, that the registers of stations write in another way than that of cities.
CITY_ALIASES = {
    ("RJ", "altodaboavista"): "riodejaneiro",
    ("RJ", "campos"): "camposdosgoytacazes",
    ("PI", "luzilandialagdopiaui"): "luzilandia",
    ("PB", "saogoncalo"): "sousa",
    ("SP", "saopaulomirdesantana"): "saopaulo",
    ("RN", "seridocaico"): "caico",
}


@dataclass(frozen=True)
class Contract:
    """What a dataset's rows must hold."""

    name: str
    key: tuple[str, ...]
    instant: str
    required: tuple[str, ...]
    references: tuple[str, ...]
    codes: dict[str, str]  # numeric column -> parameter code
    accuracy: tuple[str, ...]  # columns whose limits count as accuracy; those of the others count as validity
    limits: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)

    @property
    def numeric(self) -> tuple[str, ...]:
        return tuple(self.codes)

    def limit(self, column: str) -> tuple[float | None, float | None]:
        return self.limits.get(column) or LIMITS.get(self.codes[column], (None, None))


# The published column names of both datasets.
WATER = Contract(
    name="qualidade_agua",
    key=("id_leitura_origem",),
    instant="data_leitura",
    required=("id_leitura_origem", "id_estacao", "data_leitura", "temperatura_agua", "ph", "oxigenio", "condutividade", "turbidez"),
    references=("id_estacao",),
    codes={"temperatura_agua": "TEMP_AGUA", "ph": "PH", "oxigenio": "OD", "condutividade": "COND_ELETRICA", "turbidez": "TURBIDEZ"},
    accuracy=("temperatura_agua",),
)
WEATHER = Contract(
    name="leitura_meteorologica",
    key=("id_estacao", "data_leitura"),
    instant="data_leitura",
    required=("id_estacao", "id_cidade", "data_leitura", "temperatura_ar", "umidade", "chuva", "vento", "condicao"),
    references=("id_estacao", "id_cidade"),
    codes={"temperatura_ar": "TEMP_AR", "umidade": "UMIDADE", "chuva": "CHUVA", "vento": "VENTO"},
    accuracy=("temperatura_ar",),
)
CONTRACTS = {c.name: c for c in (WATER, WEATHER)}

# The list in a raw file's envelope, by dataset.
ENVELOPES = {"qualidade_agua": "leituras_ambientais", "leitura_meteorologica": "leituras_meteorologicas"}

# The fields of a raw record, in the order in which a contract reports the first that fails.
RAW_WATER = [
    ("id", "text"),
    ("estacao_id", "text"),
    ("timestamp", "instant"),
    ("qualidade_agua.temperatura.valor", "number"),
    ("qualidade_agua.ph.valor", "number"),
    ("qualidade_agua.oxigenio_dissolvido.valor", "number"),
    ("qualidade_agua.condutividade.valor", "number"),
    ("qualidade_agua.turbidez.valor", "number"),
]
RAW_WEATHER = [("id", "text"), ("estacao_id", "text"), ("timestamp", "instant"), ("cidade", "text"), ("estado", "text")] + [
    ("dados_meteorologicos.temperatura_ar.valor", "number"),
    ("dados_meteorologicos.umidade.valor", "number"),
    ("dados_meteorologicos.chuva.valor", "number"),
    ("dados_meteorologicos.vento.velocidade", "number"),
    ("dados_meteorologicos.condicao.description", "text"),
]
RAW_FIELDS = {"qualidade_agua": RAW_WATER, "leitura_meteorologica": RAW_WEATHER}

# Words that operators' registers use for an active or inactive operator.
ACTIVE = ("1", "ativo", "ativa", "active", "true")
INACTIVE = ("0", "inativo", "inativa", "inactive", "false", "desativado")


def contract(name: str) -> Contract:
    """The contract of a dataset; an unknown name is an error."""
    if name not in CONTRACTS:
        raise ValueError(f"unknown dataset {name!r}; known are {', '.join(sorted(CONTRACTS))}")
    return CONTRACTS[name]
