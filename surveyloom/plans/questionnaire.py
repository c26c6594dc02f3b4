"""Names and labels of the questionnaire. They describe the data, not the engine."""

from __future__ import annotations

# Column names of the unified table, answer texts and report labels.

KEY, YEAR = "id", "ano"
FIRST_EDITION, LAST_EDITION = 2023, 2025

ROLE = "atuacao"
LEVEL = "nivel"
SECTOR = "setor"
BAND = "faixa_salarial"
EDUCATION = "nivel_de_ensino"
GENDER = "genero"
RACE = "cor_raca_etnia"
REGION = "regiao_onde_mora"
MODEL_NOW = "atualmente_qual_a_sua_forma_de_trabalho"
MODEL_IDEAL = "qual_a_forma_de_trabalho_ideal_para_voce"
CLOUD_PREFERRED = "cloud_preferida"
BI_DAILY = "ferramenta_de_bi_utilizada_no_dia_a_dia"
AI_AT_WORK = "utiliza_chatgpt_ou_llms_no_trabalho"
AI_RESULTS = "empresa_esta_conseguindo_ter_bons_resultados_com_llms"
AI_PRIORITY = "ai_generativa_e_uma_prioridade_em_sua_empresa"
AI_NO_PRIORITY = "ia_generativa_e_llms_nao_e_prioridade"
DATA_LAKE = "sua_organizacao_possui_um_data_lake"
DATA_WAREHOUSE = "sua_organizacao_possui_um_data_warehouse"
PREJUDICE_GENDER = "experiencia_prejudicada_devido_a_minha_identidade_de_genero"
PREJUDICE_RACE = "experiencia_prejudicada_devido_a_minha_cor_raca_etnia"

WOMAN, MAN = "Feminino", "Masculino"

# Bands from 12.001 a month upwards.
TOP_BANDS = ["12.001", "16.001", "20.001", "24.001", "30.001", "40.001"]
TOP_PREFIX = "Acima"

# (edition, recorded values, role they stand for)
ROLE_RECODES = [
    (2025, ["0", "1", "Nao_informado"], "Gestor"),
    (2023, ["Nao_informado"], "Análise de Dados"),
]

# Multi-select answers, {report name: column}.
LANGUAGES = {
    "python": "python", "sql": "sql", "r": "r", "julia": "julia", "rust": "rust", "scala": "scala",
    "nenhuma": "nao_utilizo_nenhuma_linguagem",
}
LANGUAGES_MORE = {**LANGUAGES, "c_cpp_csharp": "c_c_c", "vba": "visual_basic_vba"}
DATABASES = {
    "mysql": "mysql", "postgresql": "postgresql", "sql_server": "sql_server", "oracle": "oracle", "s3": "s3",
    "redshift": "amazon_redshift", "bigquery": "google_bigquery", "snowflake": "snowflake",
    "databricks": "databricks", "mongodb": "mongodb",
}
DATABASES_RANKED = {
    "PostgreSQL": "postgresql", "MySQL": "mysql", "BigQuery": "google_bigquery",
    "Redshift": "amazon_redshift", "Snowflake": "snowflake", "Databricks": "databricks",
}
CLOUDS = {
    "aws": "amazon_web_services_aws", "azure": "azure_microsoft", "gcp": "google_cloud_gcp",
    "oracle_cloud": "oracle_cloud", "ibm": "ibm", "on_premise": "servidores_on_premise_nao_utilizamos_cloud",
}
CLOUDS_MAIN = {name: CLOUDS[name] for name in ("aws", "azure", "gcp", "on_premise")}
BI_TOOLS = {
    "powerbi": "microsoft_powerbi", "tableau": "tableau", "looker": "looker", "qlik": "qlik_view_qlik_sense",
    "metabase": "metabase", "grafana": "grafana",
    "so_excel": "fazemos_todas_as_analises_utilizando_apenas_excel_ou_planilhas_do_google",
    "nenhuma_bi": "nao_utilizo_nenhuma_ferramenta_de_bi_no_trabalho",
}
BI_TOOLS_RANKED = {
    "PowerBI": BI_TOOLS["powerbi"], "Tableau": "tableau", "Looker": "looker", "Grafana": "grafana",
    "Só Excel": BI_TOOLS["so_excel"],
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
    "nao_prioridade": AI_NO_PRIORITY,
}
AI_PRIORITIES = {"ia_e_prioridade": AI_PRIORITY, "nao_e_prioridade": AI_NO_PRIORITY}
AI_BARRIERS = {
    "falta_expertise": "falta_de_expertise_ou_falta_de_recursos",
    "dados_nao_prontos": "dados_da_empresa_nao_estao_prontos_para_uso_de_ia_generativa",
    "seguranca_privacidade": "preocupacoes_com_seguranca_e_privacidade_de_dados",
    "roi_nao_comprovado": "retorno_sobre_investimento_roi_nao_comprovado_de_ia_generativa",
    "alucinacao": "falta_de_confiabilidade_das_saidas_alucinacao_dos_modelos",
    "direcao_nao_ve_valor": "alta_direcao_da_empresa_nao_ve_valor_ou_nao_ve_como_prioridade",
}
AI_BARRIERS_RANKED = {
    "Dados não prontos": AI_BARRIERS["dados_nao_prontos"],
    "Segurança/privacidade": AI_BARRIERS["seguranca_privacidade"],
    "ROI não comprovado": AI_BARRIERS["roi_nao_comprovado"],
    "Direção não vê valor": AI_BARRIERS["direcao_nao_ve_valor"],
    "Falta de expertise": AI_BARRIERS["falta_expertise"],
    "Alucinação": AI_BARRIERS["alucinacao"],
}
CHALLENGES = {
    "Contratar talentos": "a_contratar_novos_talentos",
    "Reter talentos": "b_reter_talentos",
    "Convencer a investir": "c_convencer_a_empresa_a_aumentar_os_investimentos_na_area_de_dados",
    "Gerar valor p/ negócio":
        "h_conseguir_gerar_valor_para_as_areas_de_negocios_atraves_de_estudos_e_experimentos",
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

# Options of the long extracts, {column: label}.
BARRIER_OPTIONS = {
    AI_BARRIERS["roi_nao_comprovado"]: "ROI não comprovado",
    AI_BARRIERS["dados_nao_prontos"]: "Dados não prontos",
}
BARRIER_OPTIONS_MORE = {
    **BARRIER_OPTIONS, "falta_de_maturidade_analitica_na_empresa": "Falta de maturidade analítica",
}
AI_USE_OPTIONS = {
    AI_PAYER["gratis"]: "Soluções gratuitas",
    AI_PAYER["proprio_bolso"]: "Pago do próprio bolso",
    AI_PAYER["empresa_paga"]: "Empresa paga",
    "uso_solucoes_do_tipo_copilot": "Copilot (pessoal)",
    AI_IN_COMPANY["copilots"]: "Copilot (devs)",
    AI_PAYER["nao_usa"]: "Não uso IA",
}

# Text rules: (how, fragments, label), first match wins.
AI_USE_RULES = [("starts", "Utilizo", "Usa IA no trabalho"), ("starts", "Não", "Não usa IA")]
AI_USE_OTHER = "Sem informação"
AI_USE_TWO_GROUPS = [("contains", "Utilizo", "Usa IA no trabalho")]
AI_USE_TWO_OTHER = "Não usa / não informou"
AI_PRIORITY_LABELS = ("IA É prioridade na empresa", "IA NÃO é prioridade", "Outro cenário")
AI_RESULT_RULES = [
    ("starts", "sim", "Sim, bons resultados"),
    ("starts", "em partes", "Em partes / piloto"),
    ("contains", "ainda não", "Ainda não começou"),
    ("starts", "não", "Não, sem resultados"),
]
AI_RESULT_OTHER = "Sem resposta"
MODEL_RULES = [
    ("contains", "flex", "Híbrido flexível"),
    ("contains", "remoto", "100% remoto"),
    ("contains", ["híbrido", "hibrido", "fixos"], "Híbrido fixo"),
    ("contains", "presencial", "100% presencial"),
]
MODEL_OTHER = "Não informado"
MODEL_LABELS = {
    "Modelo híbrido flexível (o funcionário tem liberdade para escolher quando estar no escritório presencialmente)":
        "Híbrido flexível",
    "Modelo 100% remoto": "100% remoto",
    "Modelo híbrido com dias fixos de trabalho presencial": "Híbrido fixo",
    "Modelo 100% presencial": "100% presencial",
}

# Headers of the later editions, cleaned, and the first edition's name for each.
# A header that occurs twice in an edition asks first about dissatisfaction, then (with the
# suffix _1) about the criteria of choice.
RENAMES = {
    "token": "id",
    "sim_devido_a_minha_identidade_de_genero": "experiencia_prejudicada_devido_a_minha_identidade_de_genero",
    "sim_devido_a_minha_cor_raca_etnia": "experiencia_prejudicada_devido_a_minha_cor_raca_etnia",
    "sim_devido_ao_fato_de_ser_pcd": "experiencia_prejudicada_devido_ao_fato_de_ser_pcd",
    "situacao_de_trabalho": "qual_sua_situacao_atual_de_trabalho",
    "tempo_de_experiencia_em_dados": "quanto_tempo_de_experiencia_na_area_de_dados_voce_tem",
    "tempo_de_experiencia_em_ti":
        "quanto_tempo_de_experiencia_na_area_de_ti_engenharia_de_software_voce_teve"
        "_antes_de_comecar_a_trabalhar_na_area_de_dados",
    "satisfeito_atualmente": "voce_esta_satisfeito_na_sua_empresa_atual",
    "motivo_insatisfacao": "qual_o_principal_motivo_da_sua_insatisfacao_com_a_empresa_atual",
    "modelo_de_trabalho_atual": "atualmente_qual_a_sua_forma_de_trabalho",
    "modelo_de_trabalho_ideal": "qual_a_forma_de_trabalho_ideal_para_voce",
    "atitude_em_caso_de_retorno_presencial":
        "caso_sua_empresa_decida_pelo_modelo_100pct_presencial_qual_sera_sua_atitude",
    "contratar_talentos": "a_contratar_novos_talentos",
    "reter_talentos": "b_reter_talentos",
    "convencer_a_empresa_a_aumentar_investimentos":
        "c_convencer_a_empresa_a_aumentar_os_investimentos_na_area_de_dados",
    "gestao_de_equipes_no_ambiente_remoto": "d_gestao_de_equipes_no_ambiente_remoto",
    "gestao_de_projetos_envolvendo_areas_multidisciplinares":
        "e_gestao_de_projetos_envolvendo_areas_multidisciplinares_da_empresa",
    "organizar_as_informacoes_com_qualidade_e_confiabilidade":
        "f_organizar_as_informacoes_e_garantir_a_qualidade_e_confiabilidade",
    "processar_e_armazenar_um_alto_volume_de_dados": "g_conseguir_processar_e_armazenar_um_alto_volume_de_dados",
    "gerar_valor_para_as_areas_de_negocios":
        "h_conseguir_gerar_valor_para_as_areas_de_negocios_atraves_de_estudos_e_experimentos",
    "desenvolver_e_manter_modelos_machine_learning_em_producao":
        "i_desenvolver_e_manter_modelos_machine_learning_em_producao",
    "gerenciar_a_expectativa_das_areas":
        "j_gerenciar_a_expectativa_das_areas_de_negocio_em_relacao_as_entregas_das_equipes_de_dados",
    "garantir_a_manutencao_dos_projetos_e_modelos_em_producao":
        "k_garantir_a_manutencao_dos_projetos_e_modelos_em_producao_em_meio_ao_crescimento_da_empresa",
    "conseguir_levar_inovacao_para_a_empresa": "conseguir_levar_inovacao_para_a_empresa_atraves_dos_dados",
    "garantir_roi_em_projetos_de_dados": "garantir_retorno_do_investimento_roi_em_projetos_de_dados",
    "ai_generativa_e_llm_e_uma_prioridade": "ai_generativa_e_uma_prioridade_em_sua_empresa",
    "ai_generativa_e_llms_para_melhorar_produtos_externos_para_os_clientes_finais":
        "ai_generativa_e_llms_para_melhorar_produtos_externos",
    "atuacao_em_dados": "atuacao",
    "nao_utilizo_nenhuma_das_linguagens_listadas": "nao_utilizo_nenhuma_linguagem",
    "linguagem_mais_usada": "entre_as_linguagens_listadas_abaixo_qual_e_a_que_voce_mais_utiliza_no_trabalho",
    "ferramenta_de_bi_dia_a_dia": "ferramenta_de_bi_utilizada_no_dia_a_dia",
    "usa_chatgpt_ou_copilot_no_trabalho": "utiliza_chatgpt_ou_llms_no_trabalho",
    "possui_data_lake": "sua_organizacao_possui_um_data_lake",
    "possui_data_warehouse": "sua_organizacao_possui_um_data_warehouse",
    "plano_de_carreira_e_oportunidades_de_crescimento": "plano_de_carreira_e_oportunidades_de_crescimento_profissional",
    "remuneracao_salario": "salario_atual_nao_corresponde_ao_mercado",
    "beneficios": "gostaria_de_receber_mais_beneficios",
    "ambiente_e_clima_de_trabalho": "o_clima_de_trabalho_ambiente_nao_e_bom",
    "maturidade_da_empresa_em_termos_de_tecnologia_e_dados": "falta_de_maturidade_analitica_na_empresa",
    "oportunidades_de_crescimento": "falta_de_oportunidade_de_crescimento_no_emprego_atual",
    "relacao_com_os_gestores_e_lideres": "nao_tenho_uma_boa_relacao_com_meu_lider_gestor",
    "gostaria_de_trabalhar_em_outra_area": "gostaria_de_trabalhar_em_em_outra_area_de_atuacao",
    "remuneracao_salario_1": "remuneracao_salario",
    "beneficios_1": "beneficios",
    "proposito_do_trabalho_e_da_empresa_1": "proposito_do_trabalho_e_da_empresa",
    "flexibilidade_de_trabalho_remoto_1": "flexibilidade_de_trabalho_remoto",
    "ambiente_e_clima_de_trabalho_1": "ambiente_e_clima_de_trabalho",
    "oportunidade_de_aprendizado_e_trabalhar_com_referencias_1":
        "oportunidade_de_aprendizado_e_trabalhar_com_referencias_na_area",
    "maturidade_da_empresa_em_termos_de_tecnologia_e_dados_1": "maturidade_da_empresa_em_termos_de_tecnologia_e_dados",
    "reputacao_que_a_empresa_tem_no_mercado_1": "reputacao_que_a_empresa_tem_no_mercado",
    "relacao_com_os_gestores_e_lideres_1": "qualidade_dos_gestores_e_lideres",
}
RENAMES_2024 = {
    "forma_de_trabalho_atual": "atualmente_qual_a_sua_forma_de_trabalho",
    "forma_de_trabalho_ideal": "qual_a_forma_de_trabalho_ideal_para_voce",
    "atuacao_no_dia_a_dia": "atuacao",
    "nenhuma_linguagem": "nao_utilizo_nenhuma_linguagem",
    "linguagem_mais_utilizada": "entre_as_linguagens_listadas_abaixo_qual_e_a_que_voce_mais_utiliza_no_trabalho",
    "ferramenta_de_bi_do_dia_a_dia": "ferramenta_de_bi_utilizada_no_dia_a_dia",
    "usa_chatgpt_ou_llms_no_trabalho": "utiliza_chatgpt_ou_llms_no_trabalho",
    "ia_generativa_e_uma_prioridade_em_sua_empresa": "ai_generativa_e_uma_prioridade_em_sua_empresa",
    "ia_generativa_e_llms_para_melhorar_produtos_externos": "ai_generativa_e_llms_para_melhorar_produtos_externos",
    "contratar_novos_talentos": "a_contratar_novos_talentos",
    "convencer_a_empresa_a_aumentar_os_investimentos_na_area_de_dados":
        "c_convencer_a_empresa_a_aumentar_os_investimentos_na_area_de_dados",
    "e_gestao_de_projetos_envolvendo_areas_multidisciplinares":
        "e_gestao_de_projetos_envolvendo_areas_multidisciplinares_da_empresa",
    "f_organizar_as_informacoes_com_qualidade_e_confiabilidade":
        "f_organizar_as_informacoes_e_garantir_a_qualidade_e_confiabilidade",
    "g_processar_e_armazenar_um_alto_volume_de_dados": "g_conseguir_processar_e_armazenar_um_alto_volume_de_dados",
    "h_gerar_valor_para_as_areas_de_negocios":
        "h_conseguir_gerar_valor_para_as_areas_de_negocios_atraves_de_estudos_e_experimentos",
    "j_gerenciar_a_expectativa_das_areas":
        "j_gerenciar_a_expectativa_das_areas_de_negocio_em_relacao_as_entregas_das_equipes_de_dados",
    "k_garantir_a_manutencao_dos_projetos_e_modelos_em_producao":
        "k_garantir_a_manutencao_dos_projetos_e_modelos_em_producao_em_meio_ao_crescimento_da_empresa",
}


def mapping_rows() -> list[tuple[str, int, str, str]]:
    """The renames as mapping rows ``(edition, step, source, target)``."""
    rows = [("2024", 1, source, target) for source, target in RENAMES_2024.items()]
    return rows + [(year, 2, source, target) for year in ("2024", "2025") for source, target in RENAMES.items()]
