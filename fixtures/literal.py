"""Names, labels and answers of the questionnaire as the SQL twins know them, written out independently.

Fixed values, in plain text: a name or label changed or swapped in the engine no longer agrees with these.
"""


SECTOR = "setor"
BAND = "faixa_salarial"
GENDER = "genero"
RACE = "cor_raca_etnia"
REGION = "regiao_onde_mora"
MODEL_NOW = "atualmente_qual_a_sua_forma_de_trabalho"
MODEL_IDEAL = "qual_a_forma_de_trabalho_ideal_para_voce"
BI_DAILY = "ferramenta_de_bi_utilizada_no_dia_a_dia"
AI_AT_WORK = "utiliza_chatgpt_ou_llms_no_trabalho"
AI_RESULTS = "empresa_esta_conseguindo_ter_bons_resultados_com_llms"
AI_PRIORITY = "ai_generativa_e_uma_prioridade_em_sua_empresa"
AI_NO_PRIORITY = "ia_generativa_e_llms_nao_e_prioridade"
DATA_LAKE = "sua_organizacao_possui_um_data_lake"
DATA_WAREHOUSE = "sua_organizacao_possui_um_data_warehouse"
PREJUDICE_GENDER = "experiencia_prejudicada_devido_a_minha_identidade_de_genero"
PREJUDICE_RACE = "experiencia_prejudicada_devido_a_minha_cor_raca_etnia"
FREE_AI = "uso_solucoes_gratuitas_de_ai_generativa_com_foco_em_produtividade"

LANGUAGES = {
    "python": "python",
    "sql": "sql",
    "r": "r",
    "julia": "julia",
    "rust": "rust",
    "scala": "scala",
    "nenhuma": "nao_utilizo_nenhuma_linguagem",
}
LANGUAGES_MORE = {
    "python": "python",
    "sql": "sql",
    "r": "r",
    "julia": "julia",
    "rust": "rust",
    "scala": "scala",
    "nenhuma": "nao_utilizo_nenhuma_linguagem",
    "c_cpp_csharp": "c_c_c",
    "vba": "visual_basic_vba",
}
DATABASES = {
    "mysql": "mysql",
    "postgresql": "postgresql",
    "sql_server": "sql_server",
    "oracle": "oracle",
    "s3": "s3",
    "redshift": "amazon_redshift",
    "bigquery": "google_bigquery",
    "snowflake": "snowflake",
    "databricks": "databricks",
    "mongodb": "mongodb",
}
DATABASES_RANKED = {
    "PostgreSQL": "postgresql",
    "MySQL": "mysql",
    "BigQuery": "google_bigquery",
    "Redshift": "amazon_redshift",
    "Snowflake": "snowflake",
    "Databricks": "databricks",
}
CLOUDS = {
    "aws": "amazon_web_services_aws",
    "azure": "azure_microsoft",
    "gcp": "google_cloud_gcp",
    "oracle_cloud": "oracle_cloud",
    "ibm": "ibm",
    "on_premise": "servidores_on_premise_nao_utilizamos_cloud",
}
CLOUDS_MAIN = {
    "aws": "amazon_web_services_aws",
    "azure": "azure_microsoft",
    "gcp": "google_cloud_gcp",
    "on_premise": "servidores_on_premise_nao_utilizamos_cloud",
}
BI_TOOLS = {
    "powerbi": "microsoft_powerbi",
    "tableau": "tableau",
    "looker": "looker",
    "qlik": "qlik_view_qlik_sense",
    "metabase": "metabase",
    "grafana": "grafana",
    "so_excel": "fazemos_todas_as_analises_utilizando_apenas_excel_ou_planilhas_do_google",
    "nenhuma_bi": "nao_utilizo_nenhuma_ferramenta_de_bi_no_trabalho",
}
BI_TOOLS_RANKED = {
    "PowerBI": "microsoft_powerbi",
    "Tableau": "tableau",
    "Looker": "looker",
    "Grafana": "grafana",
    "Só Excel": "fazemos_todas_as_analises_utilizando_apenas_excel_ou_planilhas_do_google",
}
AI_PAYER = {
    "nao_usa": "nao_uso_solucoes_de_ai_generativa_com_foco_em_produtividade",
    "gratis": "uso_solucoes_gratuitas_de_ai_generativa_com_foco_em_produtividade",
    "proprio_bolso": "uso_e_pago_pelas_solucoes_de_ai_generativa_com_foco_em_produtividade",
    "empresa_paga": "a_empresa_que_trabalho_paga_pelas_solucoes_de_ai_generativa_com_foco_em_produtividade",
}
AI_IN_COMPANY = {
    "uso_independente": "colaboradores_usando_ai_generativa_de_forma_independente_e_descentralizada",
    "centralizado": "direcionamento_centralizado_do_uso_de_ai_generativa",
    "copilots": "desenvolvedores_utilizando_copilots",
    "nao_prioridade": "ia_generativa_e_llms_nao_e_prioridade",
}
AI_PRIORITIES = {
    "ia_e_prioridade": "ai_generativa_e_uma_prioridade_em_sua_empresa",
    "nao_e_prioridade": "ia_generativa_e_llms_nao_e_prioridade",
}
AI_BARRIERS = {
    "falta_expertise": "falta_de_expertise_ou_falta_de_recursos",
    "dados_nao_prontos": "dados_da_empresa_nao_estao_prontos_para_uso_de_ia_generativa",
    "seguranca_privacidade": "preocupacoes_com_seguranca_e_privacidade_de_dados",
    "roi_nao_comprovado": "retorno_sobre_investimento_roi_nao_comprovado_de_ia_generativa",
    "alucinacao": "falta_de_confiabilidade_das_saidas_alucinacao_dos_modelos",
    "direcao_nao_ve_valor": "alta_direcao_da_empresa_nao_ve_valor_ou_nao_ve_como_prioridade",
}
AI_BARRIERS_RANKED = {
    "Dados não prontos": "dados_da_empresa_nao_estao_prontos_para_uso_de_ia_generativa",
    "Segurança/privacidade": "preocupacoes_com_seguranca_e_privacidade_de_dados",
    "ROI não comprovado": "retorno_sobre_investimento_roi_nao_comprovado_de_ia_generativa",
    "Direção não vê valor": "alta_direcao_da_empresa_nao_ve_valor_ou_nao_ve_como_prioridade",
    "Falta de expertise": "falta_de_expertise_ou_falta_de_recursos",
    "Alucinação": "falta_de_confiabilidade_das_saidas_alucinacao_dos_modelos",
}
CHALLENGES = {
    "Contratar talentos": "a_contratar_novos_talentos",
    "Reter talentos": "b_reter_talentos",
    "Convencer a investir": "c_convencer_a_empresa_a_aumentar_os_investimentos_na_area_de_dados",
    "Gerar valor p/ negócio": "h_conseguir_gerar_valor_para_as_areas_de_negocios_atraves_de_estudos_e_experimentos",
    "Provar ROI": "garantir_retorno_do_investimento_roi_em_projetos_de_dados",
}
VALUES = {
    "Remuneração": "remuneracao_salario",
    "Flexibilidade remota": "flexibilidade_de_trabalho_remoto",
    "Plano de carreira": "plano_de_carreira_e_oportunidades_de_crescimento_profissional",
    "Aprendizado": "oportunidade_de_aprendizado_e_trabalhar_com_referencias_na_area",
    "Maturidade em dados": "maturidade_da_empresa_em_termos_de_tecnologia_e_dados",
    "Propósito": "proposito_do_trabalho_e_da_empresa",
}
BARRIER_OPTIONS = {
    "retorno_sobre_investimento_roi_nao_comprovado_de_ia_generativa": "ROI não comprovado",
    "dados_da_empresa_nao_estao_prontos_para_uso_de_ia_generativa": "Dados não prontos",
}
BARRIER_OPTIONS_MORE = {
    "retorno_sobre_investimento_roi_nao_comprovado_de_ia_generativa": "ROI não comprovado",
    "dados_da_empresa_nao_estao_prontos_para_uso_de_ia_generativa": "Dados não prontos",
    "falta_de_maturidade_analitica_na_empresa": "Falta de maturidade analítica",
}
AI_USE_OPTIONS = {
    "uso_solucoes_gratuitas_de_ai_generativa_com_foco_em_produtividade": "Soluções gratuitas",
    "uso_e_pago_pelas_solucoes_de_ai_generativa_com_foco_em_produtividade": "Pago do próprio bolso",
    "a_empresa_que_trabalho_paga_pelas_solucoes_de_ai_generativa_com_foco_em_produtividade": "Empresa paga",
    "uso_solucoes_do_tipo_copilot": "Copilot (pessoal)",
    "desenvolvedores_utilizando_copilots": "Copilot (devs)",
    "nao_uso_solucoes_de_ai_generativa_com_foco_em_produtividade": "Não uso IA",
}
MODEL_LABELS = {
    "Modelo híbrido flexível (o funcionário tem liberdade para escolher quando estar no escritório presencialmente)":
        "Híbrido flexível",
    "Modelo 100% remoto": "100% remoto",
    "Modelo híbrido com dias fixos de trabalho presencial": "Híbrido fixo",
    "Modelo 100% presencial": "100% presencial",
}

# Single-choice answers: column -> (source column, {source value: answer}).
ANSWERS = {
    "atuacao": ("o_orderpriority", {
        "1-URGENT": "Engenharia de Dados",
        "2-HIGH": "Análise de Dados",
        "3-MEDIUM": "Ciência de Dados",
        "4-NOT SPECIFIED": "Nao_informado",
        "5-LOW": "0",
    }),
    "nivel": ("o_orderstatus", {
        "F": "Júnior",
        "O": "Pleno",
        "P": "Sênior",
    }),
    "nivel_de_ensino": ("c_mktsegment", {
        "AUTOMOBILE": "Graduação",
        "BUILDING": "Mestrado",
        "FURNITURE": "Doutorado",
        "HOUSEHOLD": "Nao_informado",
        "MACHINERY": "Pós-graduação",
    }),
    "atualmente_qual_a_sua_forma_de_trabalho": ("c_mktsegment", {
        "AUTOMOBILE": "Modelo 100% remoto",
        "BUILDING": "Modelo 100% presencial",
        "FURNITURE": "Modelo híbrido com dias fixos de trabalho presencial",
        "HOUSEHOLD":
            "Modelo híbrido flexível (o funcionário tem liberdade para escolher quando estar no escritório presencialmente)",
    }),
    "qual_a_forma_de_trabalho_ideal_para_voce": ("o_orderpriority", {
        "1-URGENT": "Modelo 100% remoto",
        "2-HIGH": "Modelo 100% presencial",
        "3-MEDIUM": "Outro modelo",
        "5-LOW": "Modelo híbrido com dias fixos de trabalho presencial",
    }),
    "cloud_preferida": ("c_mktsegment", {
        "AUTOMOBILE": "AWS",
        "BUILDING": "Azure",
        "FURNITURE": "GCP",
        "HOUSEHOLD": "Nao_informado",
        "MACHINERY": "AWS",
    }),
    "ferramenta_de_bi_utilizada_no_dia_a_dia": ("o_orderpriority", {
        "1-URGENT": "Tableau",
        "2-HIGH": "Looker",
        "3-MEDIUM": "Power BI",
        "4-NOT SPECIFIED": "Nao_informado",
        "5-LOW": "Power BI",
    }),
    "utiliza_chatgpt_ou_llms_no_trabalho": ("o_orderpriority", {
        "1-URGENT": "Utilizo todos os dias",
        "2-HIGH": "Utilizo às vezes",
        "3-MEDIUM": "Não utilizo",
        "4-NOT SPECIFIED": "Nao_informado",
        "5-LOW": "Prefiro não dizer; Utilizo pouco",
    }),
    "empresa_esta_conseguindo_ter_bons_resultados_com_llms": ("o_orderpriority", {
        "1-URGENT": "Sim, ótimos",
        "2-HIGH": "Em partes",
        "3-MEDIUM": "A empresa ainda não começou",
        "5-LOW": "Não conseguimos",
    }),
    "sua_organizacao_possui_um_data_lake": ("o_orderpriority", {
        "1-URGENT": "1",
        "2-HIGH": "1.0",
        "3-MEDIUM": "0",
        "4-NOT SPECIFIED": "TRUE",
        "5-LOW": "não",
    }),
    "sua_organizacao_possui_um_data_warehouse": ("o_orderstatus", {
        "F": "Sim",
        "O": "0",
        "P": "1",
    }),
}
PRICE_BANDS = [
    (100000, "de R$ 4.001/mês a R$ 6.000/mês"),
    (200000, "de R$ 8.001/mês a R$ 12.000/mês"),
    (300000, "de R$ 12.001/mês a R$ 16.000/mês"),
    (400000, "de R$ 20.001/mês a R$ 25.000/mês"),
]
TOP_BAND = "Acima de R$ 40.001/mês"
YEAR_SHIFT = 24

# Multi-select columns of the questionnaire.
TICKS = [
    "experiencia_prejudicada_devido_a_minha_identidade_de_genero",
    "experiencia_prejudicada_devido_a_minha_cor_raca_etnia",
    "python",
    "sql",
    "r",
    "julia",
    "rust",
    "scala",
    "nao_utilizo_nenhuma_linguagem",
    "c_c_c",
    "visual_basic_vba",
    "mysql",
    "postgresql",
    "sql_server",
    "oracle",
    "s3",
    "amazon_redshift",
    "google_bigquery",
    "snowflake",
    "databricks",
    "mongodb",
    "amazon_web_services_aws",
    "azure_microsoft",
    "google_cloud_gcp",
    "oracle_cloud",
    "ibm",
    "servidores_on_premise_nao_utilizamos_cloud",
    "microsoft_powerbi",
    "tableau",
    "looker",
    "qlik_view_qlik_sense",
    "metabase",
    "grafana",
    "fazemos_todas_as_analises_utilizando_apenas_excel_ou_planilhas_do_google",
    "nao_utilizo_nenhuma_ferramenta_de_bi_no_trabalho",
    "nao_uso_solucoes_de_ai_generativa_com_foco_em_produtividade",
    "uso_solucoes_gratuitas_de_ai_generativa_com_foco_em_produtividade",
    "uso_e_pago_pelas_solucoes_de_ai_generativa_com_foco_em_produtividade",
    "a_empresa_que_trabalho_paga_pelas_solucoes_de_ai_generativa_com_foco_em_produtividade",
    "colaboradores_usando_ai_generativa_de_forma_independente_e_descentralizada",
    "direcionamento_centralizado_do_uso_de_ai_generativa",
    "desenvolvedores_utilizando_copilots",
    "ia_generativa_e_llms_nao_e_prioridade",
    "ai_generativa_e_uma_prioridade_em_sua_empresa",
    "falta_de_expertise_ou_falta_de_recursos",
    "dados_da_empresa_nao_estao_prontos_para_uso_de_ia_generativa",
    "preocupacoes_com_seguranca_e_privacidade_de_dados",
    "retorno_sobre_investimento_roi_nao_comprovado_de_ia_generativa",
    "falta_de_confiabilidade_das_saidas_alucinacao_dos_modelos",
    "alta_direcao_da_empresa_nao_ve_valor_ou_nao_ve_como_prioridade",
    "a_contratar_novos_talentos",
    "b_reter_talentos",
    "c_convencer_a_empresa_a_aumentar_os_investimentos_na_area_de_dados",
    "h_conseguir_gerar_valor_para_as_areas_de_negocios_atraves_de_estudos_e_experimentos",
    "garantir_retorno_do_investimento_roi_em_projetos_de_dados",
    "remuneracao_salario",
    "flexibilidade_de_trabalho_remoto",
    "plano_de_carreira_e_oportunidades_de_crescimento_profissional",
    "oportunidade_de_aprendizado_e_trabalhar_com_referencias_na_area",
    "maturidade_da_empresa_em_termos_de_tecnologia_e_dados",
    "proposito_do_trabalho_e_da_empresa",
    "falta_de_maturidade_analitica_na_empresa",
    "uso_solucoes_do_tipo_copilot",
]
