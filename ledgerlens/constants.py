"""Fixed values that results must reproduce exactly.

Everything in this module is a literal the audit checks compare against or
emit as a result value: labels stay in Portuguese, character for character.
Nothing here is configuration; parameters live in the check signatures.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the audited checks' literals)
# ---------------------------------------------------------------------------

# "Not yet settled" sentinel settlement date.
UNSETTLED_SENTINEL = _dt.date(1900, 1, 1)

# Invoice-number marker of a reversal ("estorno").
REVERSAL_MARKER = "EST"

# Ledger profiles.
PROFILE_SUPPLIER_ADVANCE = "AFO"
PROFILE_TRAVEL_ADVANCE = "AVI"
PROFILE_DEBIT_NOTE = "TND"
PROFILE_CUSTOMER_ADVANCE = "ACL"
PROFILE_ADVANCE_RECEIPT = "DPC"
PROFILE_ADVANCE_TRANSFER = "ATC"
PROFILE_TRANSFER_CREDIT = "TCC"
PROFILE_RECEIVABLE_CREDIT = "CCR"

STATUS_OPEN = "ABERTO"
STATUS_CLOSED = "FECHADO"

# Tax-id characters removed before measuring the length: . - / and space.
TAX_ID_PUNCTUATION = ".-/ "
CPF_LENGTH = 11
CNPJ_LENGTH = 14
TAX_ID_TYPE_CPF = "CPF"
TAX_ID_TYPE_CNPJ = "CNPJ"
TAX_ID_TYPE_INVALID = "TAMANHO INVÁLIDO"

# Overdue ageing with edges 30/60/90/120/180/360/720 (receivables > 720 days).
AGING_720_LABELS = (
    "VENCIDOS ATÉ 30 DIAS",
    "VENCIDOS ATÉ 60 DIAS",
    "VENCIDOS ATÉ 90 DIAS",
    "VENCIDOS ATÉ 120 DIAS",
    "VENCIDOS ATÉ 180 DIAS",
    "VENCIDOS ATÉ 360 DIAS",
    "VENCIDOS ATÉ 720 DIAS",
    "VENCIDOS A MAIS DE 720 DIAS",
)
AGING_720_EDGES = (30, 60, 90, 120, 180, 360, 720)

# Overdue ageing with edges 30/60/90/120/180/360 (travel advances).
AGING_360_LABELS = (
    "VENCIDOS ATÉ 30 DIAS",
    "VENCIDOS ATÉ 60 DIAS",
    "VENCIDOS ATÉ 90 DIAS",
    "VENCIDOS ATÉ 120 DIAS",
    "VENCIDOS ATÉ 180 DIAS",
    "VENCIDOS ATÉ 360 DIAS",
    "VENCIDOS A MAIS DE 360 DIAS",
)
AGING_360_EDGES = (30, 60, 90, 120, 180, 360)
AGING_NO_DUE_DATE = "SEM VENCIMENTO"

# Days-to-due ageing of customer advances.
AGING_TO_DUE_LABELS = (
    "Venc. até 30 dias",
    "Venc. 31 a 60",
    "Venc. 61 a 90",
    "Venc. 91 a 120",
    "Venc. Mais 120",
)
AGING_TO_DUE_EDGES = (30, 60, 90, 120)
AGING_TO_DUE_CHECK = "Verificar"

# Offset status of customer advances.
OFFSET_OK = "OK"
OFFSET_WRITE_OFF_ACL = "Baixar ACL"
OFFSET_WRITE_OFF_DPC = "Baixar DPC"
OFFSET_WRITE_OFF_ATC = "Baixar ATC"
OFFSET_WRITE_OFF_TCC = "Baixar TCC"
OFFSET_NOT_APPLICABLE = "Não Aplicável"

# Month names, January..December, and the fallback label.
MONTH_NAMES_PT = (
    "JANEIRO",
    "FEVEREIRO",
    "MARÇO",
    "ABRIL",
    "MAIO",
    "JUNHO",
    "JULHO",
    "AGOSTO",
    "SETEMBRO",
    "OUTUBRO",
    "NOVEMBRO",
    "DEZEMBRO",
)
CHECK_LABEL = "VERIFICAR"

# Stock operations for customers without finance: code -> label.
NO_FINANCE_OPERATION_LABELS = {
    "1.7.001": "ENTRADA DE BIN (CLIENTE S/FINANCEIRO)",
    "2.7.001": "SAÍDA DE BIN (CLIENTE S/FINANCEIRO)",
}

# Sales CFOP codes (50 codes).
SALES_CFOPS = (
    "5.101", "5.102", "5.103", "5.104", "5.105", "5.106", "5.107", "5.108", "5.109",
    "5.110", "5.111", "5.112", "5.113", "5.114", "5.115", "5.116", "5.201", "5.202",
    "5.203", "5.204", "5.205", "5.206", "5.207", "5.208", "5.209", "5.401", "5.402",
    "5.403", "5.404", "5.405", "5.501", "5.502", "5.503", "5.504", "6.101", "6.102",
    "6.103", "6.104", "6.105", "6.106", "6.107", "6.108", "6.109", "6.110", "6.111",
    "6.112", "6.113", "6.114", "6.115", "6.116",
)

# Commercial group of each establishment; unmatched codes get GROUP_DEFAULT.
# (R282 appears twice in the audited list; a dict keeps it once.)
ESTABLISHMENT_GROUPS = {
    "AVANÇAR": ("R261", "R221", "R222", "R541", "R591", "R281", "R282", "R283",
                "R611", "R121", "R831", "R351", "R352", "R461", "R521"),
    "BASE": ("R201", "R311", "R312", "R313", "R191", "R781", "R301"),
    "CRESCER": ("R031", "R041", "R291", "R292", "R641", "R791", "R801"),
    "FORTALEZA": ("R651", "R671", "R681", "R021", "R181", "R691", "R131", "R721", "R751"),
    "PLANALTO": ("R211", "R341", "R451", "R481", "R711", "R231", "R234", "R471",
                 "R472", "R061", "R531"),
    "SUL": ("R071", "R074", "R382", "R501", "R502", "R661", "R701", "R491", "R492",
            "R241", "R243", "R621", "R761", "R371", "R731", "R821"),
    "VISÃO": ("R011", "R511", "R101", "R811", "R051", "R052", "R161"),
}
GROUP_DEFAULT = "CADASTRAR"

# Confirmation job.
CONFIRM_STATUS_INVALID_PHONE = "ERRO - TELEFONE INVÁLIDO"
CONFIRM_STATUS_NOT_FOUND = "ERRO - CONTATO NÃO ENCONTRADO"
CONFIRM_STATUS_ANSWERED = "RESPONDIDO"
CONFIRM_STATUS_NO_ANSWER = "SEM RESPOSTA"
CONFIRM_STATUS_NOT_SENT = "NÃO ENVIADO"
CONFIRM_COUNTRY_CODE = "55"
CONFIRM_MAX_LOCAL_DIGITS = 11
CONFIRM_NOTE_BULLET = "  • NF "
CONFIRM_DEFAULT_TIMEOUT_SECONDS = 300

# Contact-sheet header aliases (lower-cased, stripped); the first match wins.
CONTACT_ALIASES = {
    "nome_cliente": ("nome", "cliente", "nome_cliente", "nome do cliente"),
    "telefone": ("telefone", "tel", "celular", "telefone_cliente", "telefone do cliente"),
    "notas_fiscais": ("notas_fiscais", "nf", "notas", "notas fiscais", "notas_fiscais_cliente"),
}

# Result schema of the confirmation job, in this column order.
CONFIRM_RESULT_COLUMNS = ("nome_cliente", "telefone", "notas_fiscais", "status", "resposta", "data_hora")
