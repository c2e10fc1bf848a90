"""Fixed schemas of the source tables; readers fail on drift instead of inferring types."""

MONEY = "decimal(18,2)"

CERTIFICATES = (
    "cda string, tipo_divida string, id_pessoa string, da_aberto int, "
    f"valor_tot {MONEY}, valor_pago {MONEY}, vlr_tributo {MONEY}, vlr_taxa {MONEY}, "
    "tipo_tributo string, atividade_principal string, situacao string, edificacao int, cpf_cnpj_existe int, "
    "endereco_existe int, protesto int, ajuizamento int, refis int, idade_divida int, quantidade_reparcelamento int, "
    "competencia_divida string, inscricao_divida date, arrecadacao_divida string, ajuizamento_divida string"
)
_CERTIFICATES_V1 = (
    "cda string, tipo_divida string, deb_totais bigint, deb_pagos bigint, "
    f"valor_tot {MONEY}, vlr_tributo {MONEY}, vlr_taxa {MONEY}, valor_pago {MONEY}, "
    "inscricao_divida bigint, id_pessoa bigint, situacao string, "
)
PROPERTY_CERTIFICATES_V1 = _CERTIFICATES_V1 + "edificacao int, cpf_existe int, divida_protestada int, divida_ajuizada int"
BUSINESS_CERTIFICATES_V1 = _CERTIFICATES_V1 + "cpf_existe int, divida_protestada int, divida_ajuizada int"
INSTALLMENTS = (
    f"cda string, id_imovel bigint, total_valor_pago {MONEY}, valor_lancado_total {MONEY}, quantidade_reparcelamentos int"
)
INVOICES = "id_pessoa bigint, qtd_notas_2anos bigint"
DATES = "chave_tempo bigint, date date"
BILLS = (
    f"dam string, id_imovel string, id_contribuinte string, ano_fato_gerador int, vlr_total_dam {MONEY}, "
    f"vlr_pago {MONEY}, vlr_aberto {MONEY}, tipo_propriedade string, natureza_imovel string, area_construida double, "
    "idade_imovel int, qtd_pavimentos int, bairro string, data_ultimo_pagamento date, atualizacao_cadastro string"
)
HISTORY = (
    f"ano int, id_contribuinte string, pgt_cota_unica int, hist_valor_pago {MONEY}, hist_valor_total {MONEY}, "
    "num_imoveis int, reco_inscricao int, reco_debito int"
)

FIRST_GENERATION = {
    "imovel": PROPERTY_CERTIFICATES_V1,
    "mercantil": BUSINESS_CERTIFICATES_V1,
    "parcelas": INSTALLMENTS,
    "emissao_notas": INVOICES,
    "dim_datas": DATES,
}
SECOND_GENERATION = {"imovel_mercantil": CERTIFICATES, "emissao_notas": INVOICES}
