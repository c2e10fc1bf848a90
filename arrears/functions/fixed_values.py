"""Labels, weights, cuts and thresholds that results must reproduce exactly."""

# --- Fixed values: paid-ratio bands, residual bands, bill-value bands, property-age bands -----------
PAID_RATIO_EDGES = [0, 0.01, 0.25, 0.5, 0.75, 0.99, 1, 1.01]
RESIDUAL_EDGES = [-1, -0.75, -0.5, -0.25, -0.2, -0.15, -0.1, -0.05, 0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.5, 0.75, 1]
BILL_VALUE_EDGES = [0, 3000, 5000, 8000, float("inf")]
BILL_VALUE_LABELS = [">=0 <3000", ">=3000 <5000", ">=5000 <8000", ">=8000"]
PROPERTY_AGE_EDGES = [0, 20, 50, float("inf")]
PROPERTY_AGE_LABELS = ["(0, 20]", "(20, 50]", "(50, inf]"]

# --- Fixed values: accessibility labels by score ----------------------------------------------------
ACCESSIBILITY_LABELS = {
    0: "INACESSÍVEL",
    1: "POUQUISSIMO ACESSÍVEL",
    2: "POUCO ACESSÍVEL",
    3: "BEM ACESSÍVEL",
    4: "MUITO ACESSÍVEL",
}

# --- Fixed values: taxpayer classes, first generation (class, name, weight) -------------------------
CLASSES_V1 = [
    (0, "PAGADOR INTERMEDIARIO", 1.0),
    (1, "PIOR PAGADOR", -1.37166),
    (2, "BOM PAGADOR", 3.79174),
    (3, "MELHOR PAGADOR", 11.19087),
    (4, "PRIMEIRA DIVIDA", 1.0),
]
FIRST_DEBT_CLASS_V1 = 4
WORST_CLASS_V1 = "PIOR PAGADOR"
WORST_WEIGHT_V1 = -1.37166
FIRST_DEBT_NAME = "PRIMEIRA DIVIDA"
FIRST_DEBT_WEIGHT_V1 = 3.79174
WORST_WEIGHT_V15 = -1.57627
FIRST_DEBT_WEIGHT_V15 = 4.12324

# --- Fixed values: taxpayer classes, second generation (class, name, profile) -----------------------
CLASSES_V2 = [
    (0, "DEVEDOR PESSIMO", "NAO PAGA INACESSIVEL"),
    (3, "DEVEDOR RUIM", "NAO PAGA ACESSIVEL"),
    (1, "DEVEDOR CONTUMAZ", "NEGOCIADOR MTS PARC"),
    (4, "DEVEDOR BOM", "PAGADOR NEGOCIADOR"),
    (2, "DEVEDOR EXCEL", "PAGADOR ORGANICO"),
    (5, "PRIMEIRA DIVIDA", "NOVO EM DIVIDA"),
]
# Names of five and six clusters from the lowest to the highest payment history.
CLUSTER_NAMES = {
    5: ["DEVEDOR PESSIMO", "DEVEDOR RUIM", "DEVEDOR CONTUMAZ", "DEVEDOR BOM", "DEVEDOR EXCEL"],
    6: ["DEVEDOR PESSIMO", "DEVEDOR RUIM", "DEVEDOR REPARCELADOR", "DEVEDOR CONTUMAZ", "DEVEDOR NEGOCIADOR",
        "DEVEDOR EXCELENTE"],
}
# First-generation class numbers from the lowest to the highest payment history.
CLUSTER_CLASSES_V1 = [1, 0, 2, 3]
# Names in the order in which sorted discriminant coefficients are handed out.
WEIGHT_ORDER_V2 = [
    "DEVEDOR PESSIMO",
    "DEVEDOR RUIM",
    "DEVEDOR CONTUMAZ",
    "DEVEDOR BOM",
    "PRIMEIRA DIVIDA",
    "DEVEDOR EXCEL",
]

# --- Fixed values: rating rules ---------------------------------------------------------------------
# (class, lowest index, index below which the rule ends, rating); a missing lowest index means
# "any index other than 0". Rules apply in order and the last one that fits wins.
RATING_ORDER = ["ALTISSIMA", "ALTA", "MEDIA", "BAIXA", "BAIXISSIMA"]
RATING_ZERO = "BAIXISSIMA"
RATING_V1 = [
    (3, None, None, "ALTISSIMA"),
    (1, None, None, "BAIXA"),
    (2, 0.5, None, "ALTISSIMA"),
    (2, 0.1, 0.5, "ALTA"),
    (2, None, 0.1, "MEDIA"),
    (0, 0.5, None, "ALTA"),
    (0, 0.05, 0.5, "MEDIA"),
    (0, None, 0.05, "BAIXA"),
    (4, 0.3, None, "ALTA"),
    (4, 0.1, 0.3, "MEDIA"),
    (4, None, 0.1, "BAIXA"),
]
RATING_V15 = [
    (2, None, None, "ALTISSIMA"),
    (0, None, None, "BAIXA"),
    (1, 0.5, None, "ALTA"),
    (1, 0.05, 0.5, "MEDIA"),
    (1, None, 0.1, "BAIXA"),
    (3, 0.5, None, "ALTISSIMA"),
    (3, 0.05, 0.5, "ALTA"),
    (3, None, 0.05, "MEDIA"),
    (4, 0.3, None, "ALTA"),
    (4, 0.1, 0.3, "MEDIA"),
    (4, None, 0.1, "BAIXA"),
]
RATING_K5 = [
    (2, None, None, "BAIXA"),
    (3, 0.9, None, "ALTA"),
    (3, 0.6, 0.9, "MEDIA"),
    (3, None, 0.6, "BAIXA"),
    (1, 0.9, None, "ALTISSIMA"),
    (1, 0.6, 0.9, "ALTA"),
    (1, 0.2, 0.6, "MEDIA"),
    (1, None, 0.2, "BAIXA"),
    (4, 0.7, None, "ALTISSIMA"),
    (4, 0.3, 0.7, "ALTA"),
    (4, None, 0.3, "MEDIA"),
    (0, 0.4, None, "ALTISSIMA"),
    (0, 0.1, 0.4, "ALTA"),
    (0, None, 0.1, "MEDIA"),
    (5, 0.3, None, "ALTISSIMA"),
    (5, 0.1, 0.3, "ALTA"),
    (5, None, 0.1, "MEDIA"),
]
# Class numbers that the five-cluster rating gives to the class names.
RATING_K5_CLASS_OF_NAME = {
    "DEVEDOR EXCEL": 0,
    "DEVEDOR CONTUMAZ": 1,
    "DEVEDOR PESSIMO": 2,
    "DEVEDOR RUIM": 3,
    "DEVEDOR BOM": 4,
    "PRIMEIRA DIVIDA": 5,
}
RATING_K6_CLASS_OF_NAME = {
    "DEVEDOR PESSIMO": 0,
    "DEVEDOR REPARCELADOR": 1,
    "DEVEDOR NEGOCIADOR": 2,
    "DEVEDOR CONTUMAZ": 3,
    "DEVEDOR EXCELENTE": 4,
    "DEVEDOR RUIM": 5,
    "PRIMEIRA DIVIDA": 6,
}
RATING_K6 = [
    (0, None, None, "BAIXA"),
    (5, 0.9, None, "ALTA"),
    (5, 0.6, 0.9, "MEDIA"),
    (5, None, 0.6, "BAIXA"),
    (1, 0.6, None, "ALTA"),
    (1, 0.3, 0.6, "MEDIA"),
    (1, None, 0.3, "BAIXA"),
    (2, 0.8, None, "ALTISSIMA"),
    (2, 0.6, 0.8, "ALTA"),
    (2, 0.2, 0.6, "MEDIA"),
    (2, None, 0.2, "BAIXA"),
    (3, 0.9, None, "ALTISSIMA"),
    (3, 0.6, 0.9, "ALTA"),
    (3, 0.2, 0.6, "MEDIA"),
    (3, None, 0.2, "BAIXA"),
    (4, 0.3, None, "ALTISSIMA"),
    (4, 0.1, 0.3, "ALTA"),
    (4, None, 0.1, "MEDIA"),
    (6, 0.3, None, "ALTISSIMA"),
    (6, 0.1, 0.3, "ALTA"),
    (6, None, 0.1, "MEDIA"),
]
# Quantile rating: ratings at or above the .75 quantile, from the .5 quantile up, and below it.
RATING_QUANTILE_LEVELS = [0.5, 0.75]
RATING_QUANTILE_CLASSES = {
    1: ("ALTISSIMA", "ALTA", "MEDIA"),
    3: ("ALTA", "MEDIA", "BAIXA"),
}
RATING_QUANTILE_CLASS_ALWAYS_TOP = (2, "ALTISSIMA")
RATING_QUANTILE_CLASS_BAD = (0, "BAIXA")
RATING_QUANTILE_CLASS_FIRST = (4, "ALTA")

# --- Fixed values: scoring overrides, slices and gates ----------------------------------------------
AGE_WITHOUT_RECOVERY = 15
TRAINING_AGE_LIMIT = 10
CREDIT_FIRST_YEAR = 2017
GATE_R2 = 0.82
GATE_MSE = 0.019
GATE_CLUSTERS = 4
SEED = 1337

# --- Fixed values: collection actions (debt type, action, from value, below value) ------------------
ACTIONS = [
    ("imovel", "negativar", 1000, 3000),
    ("imovel", "protesto", 3000, 50000),
    ("imovel", "ajuizamento", 50000, None),
    ("mercantil", "negativar", 1000, 3000),
    ("mercantil", "protesto", 3000, 200000),
    ("mercantil", "ajuizamento", 200000, None),
]
COLLECTION_RATINGS = ["MEDIA", "ALTA", "ALTISSIMA"]
COLLECTION_MAX_AGE = 3
COLLECTION_COLUMNS = [
    "cda", "id_pessoa", "atividade_principal", "idade_divida", "vlr_tributo", "vlr_taxa", "valor_total_da",
    "num_dist_cda", "quantidade_reparcelamento", "historico_pagamento_em_valor", "qtd_notas_2anos",
    "edificacao", "situacao", "situacao_cobranca", "endereco_existe", "cpf_cnpj_existe",
    "class_contribuinte_nome", "class_contribuinte_perfil", "igr", "rating_divida",
]

# --- Fixed values: property size classes (type, small above, small up to, medium up to) -------------
# "from" marks an inclusive lower end; areas outside small and medium count as large.
PROPERTY_SIZES = [
    ("APARTAMENTO", None, 60, 100),
    ("CASA", None, 100, 200),
    ("LOJA", None, 50, 200),
    ("GARAGEM COMERCIAL", None, 500, 2000),
    ("GALPÃO", ("above", 200), 500, 2000),
    ("GALPAO", ("above", 200), 500, 2000),
    ("SALA", ("from", 20), 50, 150),
]
SIZE_ORDER = ["PEQUENO", "MEDIO", "GRANDE", "INDEFINIDO"]
SIZE_NUMBERS = {"PEQUENO": 2, "MEDIO": 3, "GRANDE": 4, "INDEFINIDO": 1}
LAND_SIZE = "TERRENO"
LAND_TYPE = "TERRENO"
UNKNOWN_NEIGHBOURHOOD = "DESCONHECIDO"

# --- Fixed values: codes in the extraction tables ---------------------------------------------------
PROPERTY_PAID_STATUS = [2, 103, 105]
BUSINESS_PAID_STATUS = [2, 103]
PROPERTY_TRIBUTES = [5, 8, 19]
BUSINESS_TRIBUTES = [1, 2, 7, 11, 12]
DEBIT_FIRST_YEAR = 2018
DEBIT_CUT = "2023-06-29 00:00:00"
INVOICE_AFTER_YEAR = 2020

# --- Fixed values: two-sided 95 % Student t critical values by degrees of freedom -------------------
T_CRITICAL_95 = [
    12.706205, 4.302653, 3.182446, 2.776445, 2.570582, 2.446912, 2.364624, 2.306004, 2.262157, 2.228139,
    2.200985, 2.178813, 2.160369, 2.144787, 2.131450, 2.119905, 2.109816, 2.100922, 2.093024, 2.085963,
    2.079614, 2.073873, 2.068658, 2.063899, 2.059539, 2.055529, 2.051831, 2.048407, 2.045230, 2.042272,
]
NORMAL_CRITICAL_95 = 1.959964
