"""Fixed values of the known domains: word lists and thresholds of their business rules."""

from __future__ import annotations

# Small-spend rule over cleaned, lower-case descriptions.
SMALL_SPEND_THRESHOLD = 25_000
SMALL_SPEND_EXCLUDED = [
    "arriendo", "matricula", "cuota", "seguro", "prestamo", "impuesto", "eps", "soat",
    "transferencia", "transf", "nequi", "consignacion", "corresponsal", "retiro cajero",
    "retiro corresponsal", "abono intereses", "ajuste interes", "saldo", "cta suc virtual",
    "cta suc", "ctasuc", "cuota manejo", "dev cuota manejo", "transporte", "civica",
    "recarga de tarjeta civica", "metro", "bus", "taxi", "frisby", "home food", "bigos",
    "taco facto", "dogger", "chipstatio", "presto", "mcdonald", "dunkin", "restaurante",
    "farmacia", "droguer", "comsocial ips",
]
# Named by the rule, yet without effect: an amount up to the threshold is small spend anyway.
SMALL_SPEND_TYPICAL = ["cafe", "tinto", "snack", "pan", "gaseosa", "ara", "oxxo"]

# Ordered-list rule over trimmed, upper-case descriptions.
ORDERED_THRESHOLD = 15_000
NOT_AN_EXPENSE = [
    "ABONO INTERESES AHORROS", "AJUSTE INTERES AHORROS DB", "AJUSTE COMPRA INTL APPLE.COM",
    "CONSIGNACION CORRESPONSAL CB", "DEV CUOTA MANEJO TARJ DEB", "Recarga de Saldo",
    "TRANSFERENCIA CTA SUC VIRTUAL", "TRANSFERENCIA DESDE NEQUI",
]
ALWAYS_SMALL = ["INVERSIONE", "HYM"]
NEVER_SMALL = {
    "almuerzos": [
        "HOME FOOD", "BIGOS", "FRISBY", "ALDEA NIKK", "TACO FACTO", "CREPES Y W", "MCDONALD",
        "PRESTO", "MMO SANTA", "FIRE HOUSE", "EC EAFIT", "DELI OVIED", "RESTAURANTE",
        "TATIANA ANDREA",
    ],
    "salud": ["FARMACIA", "FARMATODO", "BIOSALUD", "COMSOCIAL", "VETERINARIO", "VET "],
    "servicios": ["CUOTA MANEJO", "CLARO", "APPLE", "COMISION", "UNIVERSIDAD EAF", "PAGO DE PROV"],
    "transporte": ["CIVICA", "RETIRO", "CAJERO"],
    "transferencias": ["TRANSF QR", "TRANSFERENCIA A", "TRANSFERENCIAS A", "NEQUI"],
    "supermercado": ["EXITO", "JUMBO", "METRO FATE"],
}

# Rating thresholds tried in turn for a film to count as a success.
SUCCESS_LADDER = [8.0, 7.8, 7.5, 7.0, 6.5]

# Lower bounds of the verdict tiers on cluster agreement, in percent.
VERDICT_TIERS = [(85.0, "EXCELENTE"), (75.0, "BUENO"), (60.0, "ALERTA")]
VERDICT_LOWEST = "CRITICO"

# Verdict texts of a scored film.
VERDICT_YES, VERDICT_NO = "Exitosa", "No exitosa"
VERDICT_CONFIDENCE = " (confianza: %.1f%%)"

# Numbers of trees, rounds, restarts, draws and grid points of the known analyses.
FOREST_TREES = 300
TREE_DEPTH, TREE_SPLIT = 10, 10
GRID_TREES, GRID_DEPTHS, GRID_SPLITS = [100, 200, 300], [None, 3, 5, 7, 10], [2, 5, 10]
BOOSTING_ROUNDS, BOOSTING_RATE, BOOSTING_DEPTH, BOOSTING_LEAF, BOOSTING_SHARE = 200, 0.08, 4, 3, 0.8
KMEANS_RESTARTS, KMEANS_ROUNDS = 10, 300
LOGISTIC_DRAWS, LINEAR_DRAWS = 100, 50
RBF_C, RBF_GAMMA = [0.1, 1, 10, 100], ["scale", 0.1, 0.01]
