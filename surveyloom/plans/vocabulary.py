"""What the questionnaires look like: headers, labels and rules.

Everything in this module is a fixed value. The texts must equal the published files and the
published mart labels character by character; nothing here is logic.
"""

from __future__ import annotations

CORE_EDITIONS = (2023, 2024, 2025)
HISTORY_EDITIONS = (2019, 2021, 2022)

# Rows of each published edition.
EXPECTED_ROWS = {2019: 1765, 2021: 2645, 2022: 4271, 2023: 5293, 2024: 5217, 2025: 3495}

# Display names that differ from the year.
EDITION_NAMES = {2025: "2025/26"}

# Smallest group that may be shown.
DISPLAY_MINIMUM = 30


# Harmonised column = header in the 2025 file.
HEADERS_2025 = {
    "id": "0.a_token",
    "idade": "1.a_idade",
    "faixa_idade": "1.a.1_faixa_idade",
    "genero": "1.b_genero",
    "cor_raca": "1.c_cor/raca/etnia",
    "pcd": "1.d_pcd",
    "uf": "1.i.1_uf_onde_mora",
    "regiao": "1.i.2_regiao_onde_mora",
    "nivel_ensino": "1.l_nivel_de_ensino",
    "area_formacao": "1.m_área_de_formação",
    "situacao_trabalho": "2.a_situação_de_trabalho",
    "setor": "2.b_setor",
    "num_funcionarios": "2.c_numero_de_funcionarios",
    "gestor": "2.d_atua_como_gestor",
    "cargo_gestor": "2.e_cargo_como_gestor",
    "cargo": "2.f_cargo_atual",
    "nivel": "2.g_nivel",
    "faixa_salarial": "2.h_faixa_salarial",
    "tempo_exp_dados": "2.i_tempo_de_experiencia_em_dados",
    "satisfeito": "2.k_satisfeito_atualmente",
    "entrevistas_6m": "2.m_participou_de_entrevistas_ultimos_6m",
    "mudar_emprego_6m": "2.n_planos_de_mudar_de_emprego_6m",
    "layoff": "2.p_empresa_passou_por_layoff_em_2025",
    "modelo_atual": "2.q_modelo_de_trabalho_atual",
    "modelo_ideal": "2.r_modelo_de_trabalho_ideal",
    "atitude_presencial": "2.s_atitude_em_caso_de_retorno_presencial",
    "prioridade_ia": "3.e_ai_generativa_e_llm_é_uma_prioridade?",
    "atuacao": "4.a.1_atuacao_em_dados",
    "lang_sql": "4.c.1_SQL",
    "lang_r": "4.c.2_R",
    "lang_python": "4.c.3_Python",
    "cloud_aws": "4.e.1_Amazon Web Services (AWS)",
    "cloud_gcp": "4.e.2_Google Cloud (GCP)",
    "cloud_azure": "4.e.3_Azure (Microsoft)",
    "cloud_onprem": "4.e.6_Servidores On Premise/Não utilizamos Cloud",
    "bi_powerbi": "4.g.1_Microsoft PowerBI",
    "bi_qlik": "4.g.2_Qlik View/Qlik Sense",
    "bi_tableau": "4.g.3_Tableau",
    "bi_metabase": "4.g.4_Metabase",
    "bi_looker_studio": "4.g.8_Looker Studio(Google Data Studio)",
    "genai_nao_uso": "4.j.1 Não uso soluções de AI Generativa com foco em produtividade",
    "genai_gratuito": "4.j.2 Uso soluções gratuitas de AI Generativa com foco em produtividade",
    "genai_pago_proprio": "4.j.3 Uso e pago pelas soluções de AI Generativa com foco em produtividade",
    "genai_pago_empresa": "4.j.4 A empresa que trabalho paga pelas soluções de AI Generativa com foco em produtividade",
    "genai_copilot": "4.j.5 Uso soluções do tipo Copilot",
    "crit_salario": "2.o.1_Remuneração/Salário",
    "crit_beneficios": "2.o.2_Benefícios",
    "crit_proposito": "2.o.3_Propósito do trabalho e da empresa",
    "crit_flex_remoto": "2.o.4_Flexibilidade de trabalho remoto",
    "crit_ambiente": "2.o.5_Ambiente e clima de trabalho",
    "crit_aprendizado": "2.o.6_Oportunidade de aprendizado e trabalhar com referências",
    "crit_carreira": "2.o.7_Plano de carreira e oportunidades de crescimento",
    "crit_maturidade": "2.o.8_Maturidade da empresa em termos de tecnologia e dados",
    "crit_gestores": "2.o.9_Qualidade dos gestores e líderes",
    "crit_reputacao": "2.o.10_Reputação que a empresa tem no mercado",
    "des_contratar": "3.d.1_Contratar talentos",
    "des_reter": "3.d.2_Reter talentos",
    "des_investimentos": "3.d.3_Convencer a empresa a aumentar investimentos",
    "des_remoto": "3.d.4_Gestão de equipes no ambiente remoto",
    "des_multidisciplinar": "3.d.5_Gestão de projetos envolvendo áreas multidisciplinares",
    "des_qualidade": "3.d.6_Organizar as informações com qualidade e confiabilidade",
    "des_volume": "3.d.7_Processar e armazenar um alto volume de dados",
    "des_valor": "3.d.8_Gerar valor para as áreas de negócios",
    "des_ml_prod": "3.d.9_Desenvolver e manter modelos Machine Learning em produção",
    "des_expectativas": "3.d.10_Gerenciar a expectativa das áreas",
    "des_manutencao": "3.d.11_Garantir a manutenção dos projetos e modelos em produção",
    "des_inovacao": "3.d.12_Conseguir levar inovação para a empresa",
    "des_roi": "3.d.13_Garantir (ROI) em projetos de dados",
    "des_tempo": "3.d.14_Dividir o tempo entre entregas técnicas e gestão",
}

# Headers of the 2024 file that differ from 2025.
CHANGED_HEADERS_2024 = {
    "layoff": "2.q_empresa_passou_por_layoff_em_2024",
    "modelo_atual": "2.r_modelo_de_trabalho_atual",
    "modelo_ideal": "2.s_modelo_de_trabalho_ideal",
    "atitude_presencial": "2.t_atitude_em_caso_de_retorno_presencial",
    "lang_sql": "4.d.1_SQL",
    "lang_r": "4.d.2_R",
    "lang_python": "4.d.3_Python",
    "cloud_aws": "4.h.1_Amazon Web Services (AWS)",
    "cloud_gcp": "4.h.2_Google Cloud (GCP)",
    "cloud_azure": "4.h.3_Azure (Microsoft)",
    "cloud_onprem": "4.h.6_Servidores On Premise/Não utilizamos Cloud",
    "bi_powerbi": "4.j.1_Microsoft PowerBI",
    "bi_qlik": "4.j.2_Qlik View/Qlik Sense",
    "bi_tableau": "4.j.3_Tableau",
    "bi_metabase": "4.j.4_Metabase",
    "bi_looker_studio": "4.j.8_Looker Studio(Google Data Studio)",
    "genai_nao_uso": "4.m.1 Não uso soluções de AI Generativa com foco em produtividade",
    "genai_gratuito": "4.m.2 Uso soluções gratuitas de AI Generativa com foco em produtividade",
    "genai_pago_proprio": "4.m.3 Uso e pago pelas soluções de AI Generativa com foco em produtividade",
    "genai_pago_empresa": "4.m.4 A empresa que trabalho paga pelas soluções de AI Generativa com foco em produtividade",
    "genai_copilot": "4.m.5 Uso soluções do tipo Copilot",
}

# Harmonised column = header in the 2023 file.
HEADERS_2023 = {
    "id": "('P0', 'id')",
    "idade": "('P1_a ', 'Idade')",
    "faixa_idade": "('P1_a_1 ', 'Faixa idade')",
    "genero": "('P1_b ', 'Genero')",
    "cor_raca": "('P1_c ', 'Cor/raca/etnia')",
    "pcd": "('P1_d ', 'PCD')",
    "uf": "('P1_i_1 ', 'uf onde mora')",
    "regiao": "('P1_i_2 ', 'Regiao onde mora')",
    "nivel_ensino": "('P1_l ', 'Nivel de Ensino')",
    "area_formacao": "('P1_m ', 'Área de Formação')",
    "situacao_trabalho": "('P2_a ', 'Qual sua situação atual de trabalho?')",
    "setor": "('P2_b ', 'Setor')",
    "num_funcionarios": "('P2_c ', 'Numero de Funcionarios')",
    "gestor": "('P2_d ', 'Gestor?')",
    "cargo_gestor": "('P2_e ', 'Cargo como Gestor')",
    "cargo": "('P2_f ', 'Cargo Atual')",
    "nivel": "('P2_g ', 'Nivel')",
    "faixa_salarial": "('P2_h ', 'Faixa salarial')",
    "tempo_exp_dados": "('P2_i ', 'Quanto tempo de experiência na área de dados você tem?')",
    "satisfeito": "('P2_k ', 'Você está satisfeito na sua empresa atual?')",
    "entrevistas_6m": "('P2_m ', 'Você participou de entrevistas de emprego nos últimos 6 meses?')",
    "mudar_emprego_6m": "('P2_n ', 'Você pretende mudar de emprego nos próximos 6 meses?')",
    "layoff": "('P2_q ', 'Empresa que trabaha passou por layoff em 2023')",
    "modelo_atual": "('P2_r ', 'Atualmente qual a sua forma de trabalho?')",
    "modelo_ideal": "('P2_s ', 'Qual a forma de trabalho ideal para você?')",
    "atitude_presencial": "('P2_t ', 'Caso sua empresa decida pelo modelo 100% presencial qual será sua atitude?')",
    "prioridade_ia": "('P3_e ', 'AI Generativa é uma prioridade em sua empresa?')",
    "atuacao": "('P4_a_1 ', 'Atuacao')",
    "lang_sql": "('P4_d_1 ', 'SQL')",
    "lang_r": "('P4_d_2 ', 'R ')",
    "lang_python": "('P4_d_3 ', 'Python')",
    "cloud_aws": "('P4_h_2 ', 'Amazon Web Services (AWS)')",
    "cloud_gcp": "('P4_h_3 ', 'Google Cloud (GCP)')",
    "cloud_azure": "('P4_h_1 ', 'Azure (Microsoft)')",
    "cloud_onprem": "('P4_h_6 ', 'Servidores On Premise/Não utilizamos Cloud')",
    "bi_powerbi": "('P4_j_1 ', 'Microsoft PowerBI')",
    "bi_qlik": "('P4_j_2 ', 'Qlik View/Qlik Sense')",
    "bi_tableau": "('P4_j_3 ', 'Tableau')",
    "bi_metabase": "('P4_j_4 ', 'Metabase')",
    "bi_looker_studio": "('P4_j_8 ', 'Looker Studio(Google Data Studio)')",
    "genai_nao_uso": "('P4_m_1 ', 'Não uso soluções de AI Generativa com foco em produtividade')",
    "genai_gratuito": "('P4_m_2 ', 'Uso soluções gratuitas de AI Generativa com foco em produtividade')",
    "genai_pago_proprio": "('P4_m_3 ', 'Uso e pago pelas soluções de AI Generativa com foco em produtividade')",
    "genai_pago_empresa": "('P4_m_4 ', 'A empresa que trabalho paga pelas soluções de AI Generativa com foco em produtividade')",
    "genai_copilot": "('P4_m_5 ', 'Uso soluções do tipo Copilot')",
    "crit_salario": "('P2_o_1 ', 'Remuneração/Salário')",
    "crit_beneficios": "('P2_o_2 ', 'Benefícios')",
    "crit_proposito": "('P2_o_3 ', 'Propósito do trabalho e da empresa')",
    "crit_flex_remoto": "('P2_o_4 ', 'Flexibilidade de trabalho remoto')",
    "crit_ambiente": "('P2_o_5 ', 'Ambiente e clima de trabalho')",
    "crit_aprendizado": "('P2_o_6 ', 'Oportunidade de aprendizado e trabalhar com referências na área')",
    "crit_carreira": "('P2_o_7 ', 'Plano de carreira e oportunidades de crescimento profissional')",
    "crit_maturidade": "('P2_o_8 ', 'Maturidade da empresa em termos de tecnologia e dados')",
    "crit_gestores": "('P2_o_9 ', 'Qualidade dos gestores e líderes')",
    "crit_reputacao": "('P2_o_10 ', 'Reputação que a empresa tem no mercado')",
    "des_contratar": "('P3_d_1 ', 'a Contratar novos talentos.')",
    "des_reter": "('P3_d_2 ', 'b Reter talentos.')",
    "des_investimentos": "('P3_d_3 ', 'c Convencer a empresa a aumentar os investimentos na área de dados.')",
    "des_remoto": "('P3_d_4 ', 'd Gestão de equipes no ambiente remoto.')",
    "des_multidisciplinar": "('P3_d_5 ', 'e Gestão de projetos envolvendo áreas multidisciplinares da empresa.')",
    "des_qualidade": "('P3_d_6 ', 'f Organizar as informações e garantir a qualidade e confiabilidade.')",
    "des_volume": "('P3_d_7 ', 'g Conseguir processar e armazenar um alto volume de dados.')",
    "des_valor": "('P3_d_8 ', 'h Conseguir gerar valor para as áreas de negócios através de estudos e experimentos.')",
    "des_ml_prod": "('P3_d_9 ', 'i Desenvolver e manter modelos Machine Learning em produção.')",
    "des_expectativas": "('P3_d_10 ', 'j Gerenciar a expectativa das áreas de negócio em relação as entregas das equipes de dados.')",
    "des_manutencao": "('P3_d_11 ', 'k Garantir a manutenção dos projetos e modelos em produção, em meio ao crescimento da empresa.')",
    "des_inovacao": "('P3_d_12 ', 'Conseguir levar inovação para a empresa através dos dados.')",
    "des_roi": "('P3_d_13 ', 'Garantir retorno do investimento (ROI) em projetos de dados.')",
    "des_tempo": "('P3_d_14 ', 'Dividir o tempo entre entregas técnicas e gestão.')",
}

# The seven long-series columns = headers in the older files.
HEADERS_2019 = {
    "genero": "('P2', 'gender')",
    "lang_sql": "('P21', 'sql_')",
    "lang_r": "('P21', 'r')",
    "lang_python": "('P21', 'python')",
    "cloud_aws": "('P25', 'aws')",
    "cloud_gcp": "('P25', 'gcp')",
    "cloud_azure": "('P25', 'azure')",
}
HEADERS_2021 = {
    "genero": "('P1_b ', 'Genero')",
    "lang_sql": "('P4_d_a ', 'SQL')",
    "lang_r": "('P4_d_b ', 'R ')",
    "lang_python": "('P4_d_c ', 'Python')",
    "cloud_aws": "('P4_g_a ', 'Amazon Web Services (AWS)')",
    "cloud_gcp": "('P4_g_b ', 'Google Cloud (GCP)')",
    "cloud_azure": "('P4_g_c ', 'Azure (Microsoft)')",
}
HEADERS_2022 = {
    "genero": "('P1_b ', 'Genero')",
    "lang_sql": "('P4_d_1 ', 'SQL')",
    "lang_r": "('P4_d_2 ', 'R ')",
    "lang_python": "('P4_d_3 ', 'Python')",
    "cloud_aws": "('P4_h_2 ', 'Amazon Web Services (AWS)')",
    "cloud_gcp": "('P4_h_3 ', 'Google Cloud (GCP)')",
    "cloud_azure": "('P4_h_1 ', 'Azure (Microsoft)')",
}

CORE_HEADERS = {
    2023: HEADERS_2023,
    2024: {**HEADERS_2025, **CHANGED_HEADERS_2024},
    2025: HEADERS_2025,
}
HISTORY_HEADERS = {2019: HEADERS_2019, 2021: HEADERS_2021, 2022: HEADERS_2022}

# Columns of the long series, in order.
LONG_COLUMNS = ("ano", "genero", "lang_sql", "lang_r", "lang_python",
                "cloud_aws", "cloud_gcp", "cloud_azure")

# Blocks of yes/no columns, by prefix, and the two that carry none.
FLAG_PREFIXES = ("lang_", "cloud_", "bi_", "genai_", "crit_", "des_")
SINGLE_FLAGS = ("gestor", "satisfeito")

# Role family and the fragments that select it; the first hit wins.
ROLE_FAMILIES = (
    ("Outros", ("outra",)),
    ("Engenharia/Arquitetura de Dados", ("engenheiro de dados", "data engineer", "arquiteto")),
    ("Análise de Dados", ("analista de dados", "data analyst")),
    ("Ciência de Dados", ("cientista de dados", "data scientist")),
    ("Business Intelligence", ("analista de bi", "bi analyst")),
    ("Analytics Engineer", ("analytics engineer",)),
    ("ML/AI Engineer", ("machine learning", "ml engineer", "ai engineer")),
    ("Análise de Negócios", ("negócios", "business analyst")),
    ("Eng. de Software", ("desenvolvedor", "software", "sistemas")),
    ("Produto (DPM/PM)", ("product", "produto")),
    ("DBA", ("dba", "administrador de banco")),
    ("Estatística/Economia", ("estatístico", "economista")),
    ("Professor/Pesquisador", ("professor", "pesquisador")),
)
ROLE_DEFAULT = "Outros"

# Work model and the fragments that select it.
WORK_MODELS = (
    ("100% remoto", ("100% remoto",)),
    ("100% presencial", ("100% presencial",)),
    ("Híbrido (dias fixos)", ("dias fixos",)),
    ("Híbrido flexível", ("flexível", "flexivel")),
)
WORK_MODEL_DEFAULT = "Outro"
WORK_MODEL_ORDER = ("100% presencial", "Híbrido (dias fixos)", "Híbrido flexível", "100% remoto")

# Priority label and the prefix that selects it.
AI_PRIORITIES = (
    ("1. Principal prioridade da empresa", "Sim, é nossa principal"),
    ("2. Entre as principais (2-4 anos)", "Sim, está entre"),
    ("3. Iniciativas isoladas, sem foco", "Mais ou menos"),
    ("4. Não é prioridade", "Não é uma iniciativa"),
)
AI_PRIORITY_DEFAULT = "5. Não sabe opinar"

# Levels in order, and those counted as senior or above.
LEVELS = ("Júnior", "Pleno", "Sênior", "Especialista/Staff+")
SENIOR = "Sênior"
SENIOR_PLUS = ("Sênior", "Especialista/Staff+")
COMPARED_GENDERS = ("Masculino", "Feminino")

# Labels of the multi-response marts.
LANGUAGES = {"lang_sql": "SQL", "lang_python": "Python", "lang_r": "R"}
CLOUDS = {"cloud_aws": "AWS", "cloud_gcp": "GCP", "cloud_azure": "Azure"}
BI_TOOLS = {
    "bi_powerbi": "Power BI",
    "bi_tableau": "Tableau",
    "bi_looker_studio": "Looker Studio",
    "bi_metabase": "Metabase",
    "bi_qlik": "Qlik",
}
GENAI_USES = {
    "genai_nao_uso": "Não usa GenAI",
    "genai_gratuito": "Usa soluções gratuitas",
    "genai_pago_proprio": "Paga do próprio bolso",
    "genai_pago_empresa": "Empresa paga",
    "genai_copilot": "Usa Copilot",
}
JOB_CRITERIA = {
    "crit_salario": "Remuneração/Salário",
    "crit_beneficios": "Benefícios",
    "crit_proposito": "Propósito da empresa",
    "crit_flex_remoto": "Flexibilidade remota",
    "crit_ambiente": "Ambiente de trabalho",
    "crit_aprendizado": "Aprendizado/referências",
    "crit_carreira": "Plano de carreira",
    "crit_maturidade": "Maturidade tech/dados",
    "crit_gestores": "Qualidade dos gestores",
    "crit_reputacao": "Reputação da empresa",
}
MANAGER_CHALLENGES = {
    "des_contratar": "Contratar talentos",
    "des_reter": "Reter talentos",
    "des_investimentos": "Aumentar investimentos",
    "des_remoto": "Gestão remota",
    "des_multidisciplinar": "Projetos multidisciplinares",
    "des_qualidade": "Qualidade dos dados",
    "des_volume": "Alto volume de dados",
    "des_valor": "Gerar valor p/ negócio",
    "des_ml_prod": "ML em produção",
    "des_expectativas": "Expectativa das áreas",
    "des_manutencao": "Manutenção em produção",
    "des_inovacao": "Levar inovação",
    "des_roi": "Garantir ROI",
    "des_tempo": "Tempo técnico × gestão",
}

# Why a column may be empty.
EMPTY_REASONS = {
    "genero": "pergunta universal",
    "atuacao": "pergunta universal",
    "faixa_salarial": "apenas quem tem vínculo ativo",
    "modelo_atual": "apenas quem tem vínculo ativo",
    "satisfeito": "apenas quem tem vínculo ativo",
    "nivel": "apenas contribuidores individuais empregados",
    "cargo": "apenas contribuidores individuais empregados",
    "cargo_gestor": "apenas gestores",
    "prioridade_ia": "bloco exclusivo de gestores",
}

# The resampling study of small groups.
RESAMPLES = 3000
RESAMPLE_SEED = 43
