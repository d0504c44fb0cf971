"""Fixed values.

Every value below must equal the reference's for the results to match (labels,
messages, XML element names, word lists, rates, limits and rule tokens). They are
stated plainly and in their natural order; nothing else in the library hard-codes
an output literal of the reference.
"""

from __future__ import annotations

from decimal import Decimal

# --- fixed values: calendar words --------------------------------------------------
SPANISH_MONTHS = [
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
]

# --- fixed values: monthly expenses file ------------------------------------------
# amount keys of one JSON object, in file order
EXPENSE_JSON_KEYS = [
    "BANCARIOS", "LIMPIEZA", "ADMINISTRACION", "SEGUROS", "GASTOS GENERALES",
    "SERVICIOS PUBLICOS-Agua", "SERVICIOS PUBLICOS-Luz",
]
EXTRAORDINARY_CATEGORY = "GASTOS GENERALES"
KIND_ORDINARY = "Ordinario"
KIND_EXTRAORDINARY = "Extraordinario"
INVOICE_PREFIX = "FAC-"
# provider rules: (token in the expense description, provider category, required provider)
PROVIDER_RULES = [
    ("BANCARIOS", "GASTOS BANCARIOS", None),
    ("ADMINISTRACION", "GASTOS DE ADMINISTRACION", None),
    ("SEGUROS", "SEGUROS", None),
    ("LIMPIEZA", "GASTOS DE LIMPIEZA", None),
    ("AGUA", "SERVICIOS PUBLICOS", "AYSA"),
    ("LUZ", "SERVICIOS PUBLICOS", "EDENOR"),
]

# --- fixed values: amounts and rates ------------------------------------------------
AMOUNT_CEILING = Decimal("99999999.99")
FLAT_INTEREST = Decimal("0.05")          # carry-forward interest of the import
BASE_RATE = Decimal("0.02")              # late interest after the first due date
MONTHLY_RATE = Decimal("0.005")          # per month boundary after the second due date
CAP_RATE = Decimal("0.50")               # cap, as a share of the prior balance
FALLBACK_DUE_DAYS = 30                   # second due date when missing (interval match)
FEE_FIRST, FEE_NEXT = Decimal("2.00"), Decimal("5.00")
PLACEHOLDER_ADDRESS_PREFIX = "Dirección "
PLACEHOLDER_AREA = Decimal("1000.00")

# --- fixed values: people ------------------------------------------------------------
ROLE_OWNER = "Propietario"
ROLE_TENANT = "Inquilino"
NOT_GIVEN = "No informado"
FIRST_PAYMENT = "Primer Pago"

# --- fixed values: report labels and messages ------------------------------------------
TOP_INCOME_LABEL = "MAYORES INGRESOS"
TOP_EXPENSE_LABEL = "MAYORES GASTOS"
DEBTOR_LABEL = "DEUDOR"
ORDINARY_LABEL = "ORDINARIO"
EXTRAORDINARY_LABEL = "EXTRAORDINARIO"
FINANCIAL_LABEL = "ESTADO_FINANCIERO"
APPORTIONMENT_LABEL = "PRORRATEO"
TOTAL_CONCEPTS = [
    "TOTAL_GASTO_ORDINARIO", "TOTAL_GASTO_EXTRAORDINARIO", "TOTAL_EXPENSA_A_REPARTIR",
    "TOTAL_PAGOS_RECIBIDOS", "TOTAL_SALDO_ANTERIOR", "TOTAL_DEUDA_PENDIENTE",
]
HEADER_ITEMS = [  # (section, item) of the statement header, in order
    ("ENCABEZADO", "Nombre Administración"),
    ("ENCABEZADO", "CUIT Administración"),
    ("CONSORCIO", "Nombre"),
    ("CONSORCIO", "Dirección"),
    ("VENCIMIENTOS", "Periodo"),
    ("VENCIMIENTOS", "Fecha Vto 1"),
    ("VENCIMIENTOS", "Fecha Vto 2"),
    ("FORMA DE PAGO", "Medio"),
    ("FORMA DE PAGO", "CVU (Consorcio)"),
]
PAYMENT_MEANS = "Transferencia Bancaria"
UNKNOWN_BUILDING = "El Consorcio no existe"
MISSING_BUILDINGS = "Los siguientes consorcios no existen en la base de datos: "
NONE_IDENTIFIED = "Ninguno identificado"
INTEREST_INFO = "INTERESES CALCULADOS"
SUMMARY_INFO = "Resumen final"
LOG_LEVELS = ("INFO", "WARN", "ERROR")

# --- fixed values: XML and HTML renderings ---------------------------------------------
INCOME_XML = ("RecaudacionPorOrigen", "Periodo",
              ["Anio", "Mes", "NombreMes", "RecaudacionOrdinaria", "RecaudacionExtraordinaria", "TotalRecaudado"])
DEBTORS_XML = ("Top3Morosos", "Moroso", "DNI",
               ["Nombre", "Apellido", "Email", "Telefono", "UnidadFuncional", "DeudaTotal",
                "CantidadExpensasAdeudadas"])
# Debtors page: style of each cell of a row (the first has none), and the page around the rows.
HTML_CELL_STYLES = (
    None,
    "padding: 12px; border-bottom: 1px solid #ddd; white-space: nowrap; font-weight: bold;",
    "padding: 12px; border-bottom: 1px solid #ddd; white-space: nowrap;",
    "padding: 12px; border-bottom: 1px solid #ddd; color: #d9534f; text-align: right; white-space: nowrap;",
    "padding: 12px; border-bottom: 1px solid #ddd; font-size: 12px; color: #666;",
)
HTML_LINE_BREAK = "<br>"
HTML_BEFORE_NAME = (
    "<!DOCTYPE html><html>"
    "<body style=\"font-family: 'Helvetica Neue', Helvetica, Arial, sans-serif; background-color: #f4f4f4; margin: 0; "
    "padding: 20px;\">"
    "<div style=\"max-width: 700px; margin: 0 auto; background-color: #ffffff; padding: 30px; border-radius: 8px; "
    "box-shadow: 0 2px 5px rgba(0,0,0,0.1);\">"
    "<div style=\"border-bottom: 2px solid #0056b3; padding-bottom: 10px; margin-bottom: 20px;\">"
    "<h2 style=\"color: #333; margin: 0;\">Reporte de Morosidad</h2>"
    "<p style=\"color: #666; margin: 5px 0 0 0;\">Consorcio: <strong>"
)
HTML_BEFORE_ROWS = (
    "</strong></p></div>"
    "<p style=\"color: #555; line-height: 1.5;\">Estimados,</p>"
    "<p style=\"color: #555; line-height: 1.5;\">Se adjunta el listado de los <strong>3 mayores deudores</strong> al día "
    "de la fecha para iniciar las gestiones de cobranza judicial.</p>"
    "<table style=\"width: 100%; border-collapse: collapse; margin: 25px 0; font-size: 14px;\"><thead>"
    "<tr style=\"background-color: #0056b3; color: #ffffff; text-align: left;\">"
    "<th style=\"padding: 12px;\">DNI</th><th style=\"padding: 12px;\">Nombre</th><th style=\"padding: 12px;\">UF</th>"
    "<th style=\"padding: 12px; text-align: right;\">Deuda Total</th><th style=\"padding: 12px;\">Contacto</th>"
    "</tr></thead><tbody>"
)
HTML_AFTER_ROWS = (
    "</tbody></table>"
    "<div style=\"margin-top: 30px; padding-top: 20px; border-top: 1px solid #eee; font-size: 12px; color: #999; "
    "text-align: center;\"><p>Este es un reporte automático generado por el <strong>Sistema de Gestión de Consorcios"
    "</strong>.</p><p>Por favor no responder a este correo.</p></div></div></body></html>"
)
