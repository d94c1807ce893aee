"""Dimension tables: models, languages, language-code aliases, extraction rules,
sampling parameters and prompt templates.

Each table is kept as literal text (the fixed values that results must agree
with) and turned into a small Spark DataFrame on demand. All of them are tiny
and of fixed size (at most a few hundred rows), so they are safe to broadcast.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: model registry.
# model, hub_path, family, tensor_parallel, in_benchmark, in_translation,
# in_backfill, translation_dir (the spelling used for translation folders)
# ---------------------------------------------------------------------------
MODELS_CSV = """\
Qwen3-4B,Qwen/Qwen3-4B,qwen,2,1,1,1,Qwen3-4B
Qwen3-8B,Qwen/Qwen3-8B,qwen,2,1,1,1,Qwen3-8B
Qwen3-14B,Qwen/Qwen3-14B,qwen,2,1,1,1,Qwen3-14B
Qwen3-32B,Qwen/Qwen3-32B,qwen,2,1,1,1,Qwen3-32B
Qwen3-30B-A3B,Qwen/Qwen3-30B-A3B,qwen,2,1,1,1,Qwen3-30B-A3B
Qwen2.5-72B-Instruct,Qwen/Qwen2.5-72B-Instruct,qwen,4,1,1,1,Qwen2.5-72B-Instruct
Gemma-3-1B-it,google/gemma-3-1b-it,gemma,2,1,1,1,Gemma-3-1B-it
Gemma-3-4B-it,google/gemma-3-4b-it,gemma,2,1,1,1,Gemma-3-4B-it
Gemma-3-12B-it,google/gemma-3-12b-it,gemma,2,1,1,1,Gemma-3-12B-it
Gemma-3-27B-it,google/gemma-3-27b-it,gemma,2,1,1,1,Gemma-3-27B-it
Llama-3.3-70B-Instruct,meta-llama/Llama-3.3-70B-Instruct,llama,4,1,1,1,Llama-3.3-70B-Instruct
DeepSeek-R1-Distill-Qwen-32B,deepseek-ai/DeepSeek-R1-Distill-Qwen-32B,deepseek,2,1,1,1,DeepSeek-R1-Distill-Qwen-32B
DeepSeek-R1-Distill-Llama-70B,deepseek-ai/DeepSeek-R1-Distill-Llama-70B,deepseek,4,1,1,1,DeepSeek-R1-Distill-Llama-70B
Mistral-Small-24B-Instruct-2501,mistralai/Mistral-Small-24B-Instruct-2501,mistral,2,0,1,0,Mistral-Small-24B-Instruct-2501
Phi-4,microsoft/phi-4,phi,2,1,1,1,phi-4
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: language dimension, 120 rows in their original order.
# lang_code, name, flores_code, wmt_code, ntrex_code (empty = no code)
# ---------------------------------------------------------------------------
LANGUAGES_CSV = """\
afr,Afrikaans,afr_Latn,,afr_Latn
amh,Amharic,amh_Ethi,,amh_Ethi
hye,Armenian,hye_Armn,,hye_Armn
asm,Assamese,asm_Beng,,
bam,Bambara,bam_Latn,,
eus,Basque,eus_Latn,,eus_Latn
bel,Belarusian,bel_Cyrl,,
ben,Bengali,ben_Beng,bn_IN,ben_Beng
bul,Bulgarian,bul_Cyrl,bg_BG,bul_Cyrl
mya,Burmese,mya_Mymr,,mya_Mymr
cat,Catalan,cat_Latn,ca_ES,cat_Latn
ceb,Cebuano,ceb_Latn,,
ckb,Central Kurdish,ckb_Arab,,ckb_Arab
zho,Chinese (Simplified),zho_Hans,zh_CN,zho_Hans
zho_trad,Chinese (Traditional),zho_Hant,zh_TW,zho_Hant
hrv,Croatian,hrv_Latn,hr_HR,hrv_Latn
ces,Czech,ces_Latn,cs_CZ,ces_Latn
dan,Danish,dan_Latn,da_DK,dan_Latn
nld,Dutch,nld_Latn,nl_NL,nld_Latn
pan,Eastern Panjabi,pan_Guru,pa_IN,pan_Guru
arz,Egyptian Arabic,arz_Arab,ar_EG,
eng,English,eng_Latn,,eng_Latn
est,Estonian,est_Latn,et_EE,est_Latn
ewe,Ewe,ewe_Latn,,ewe_Latn
fin,Finnish,fin_Latn,fi_FI,fin_Latn
fra,French,fra_Latn,fr_FR,fra_Latn
kat,Georgian,kat_Geor,,kat_Geor
deu,German,deu_Latn,de_DE,deu_Latn
ell,Greek,ell_Grek,el_GR,ell_Grek
grn,Guarani,grn_Latn,,
guj,Gujarati,guj_Gujr,gu_IN,guj_Gujr
hat,Haitian Creole,hat_Latn,,
khk,Halh Mongolian,khk_Cyrl,,mon_Mong
hau,Hausa,hau_Latn,,hau_Latn
heb,Hebrew,heb_Hebr,he_IL,heb_Hebr
hin,Hindi,hin_Deva,hi_IN,hin_Deva
hun,Hungarian,hun_Latn,hu_HU,hun_Latn
isl,Icelandic,isl_Latn,is_IS,isl_Latn
ibo,Igbo,ibo_Latn,,ibo_Latn
ilo,Ilocano,ilo_Latn,,
ind,Indonesian,ind_Latn,id_ID,ind_Latn
ita,Italian,ita_Latn,it_IT,ita_Latn
jpn,Japanese,jpn_Jpan,ja_JP,jpn_Jpan
jav,Javanese,jav_Latn,,
kac,Jingpho,kac_Latn,,
kea,Kabuverdianu,kea_Latn,,
kan,Kannada,kan_Knda,kn_IN,kan_Knda
kaz,Kazakh,kaz_Cyrl,,kaz_Cyrl
khm,Khmer,khm_Khmr,,khm_Khmr
kin,Kinyarwanda,kin_Latn,,kin_Latn
kor,Korean,kor_Hang,ko_KR,kor_Hang
kir,Kyrgyz,kir_Cyrl,,kir_Cyrl
lao,Lao,lao_Laoo,,lao_Laoo
lin,Lingala,lin_Latn,,
lit,Lithuanian,lit_Latn,lt_LT,lit_Latn
lug,Luganda,lug_Latn,,
luo,Luo,luo_Latn,,
mkd,Macedonian,mkd_Cyrl,,mkd_Cyrl
mal,Malayalam,mal_Mlym,ml_IN,mal_Mlym
mlt,Maltese,mlt_Latn,,mlt_Latn
mri,Maori,mri_Latn,,mri_Latn
mar,Marathi,mar_Deva,mr_IN,mar_Deva
acm,Mesopotamian Arabic,acm_Arab,,
arb,Modern Standard Arabic,arb_Arab,ar_SA,arb_Arab
ary,Moroccan Arabic,ary_Arab,,
ars,Najdi Arabic,ars_Arab,,
npi,Nepali,npi_Deva,,
fuv,Nigerian Fulfulde,fuv_Latn,,
azj,North Azerbaijani,azj_Latn,,aze_Latn
apc,North Levantine Arabic,apc_Arab,,
nso,Northern Sotho,nso_Latn,,nso_Latn
uzn,Northern Uzbek,uzn_Latn,,
nob,Norwegian Bokmål,nob_Latn,no_NO,nob_Latn
nya,Nyanja,nya_Latn,,nya_Latn
ory,Oriya,ory_Orya,,
plt,Plateau Malagasy,plt_Latn,,
pol,Polish,pol_Latn,pl_PL,pol_Latn
por,Portuguese,por_Latn,pt_PT,por_Latn
ron,Romanian,ron_Latn,ro_RO,ron_Latn
rus,Russian,rus_Cyrl,ru_RU,rus_Cyrl
srp,Serbian,srp_Cyrl,sr_RS,srp_Cyrl
shn,Shan,shn_Mymr,,
sna,Shona,sna_Latn,,sna_Latn
snd,Sindhi,snd_Arab,,snd_Arab
sin,Sinhala,sin_Sinh,,sin_Sinh
slk,Slovak,slk_Latn,sk_SK,slk_Latn
slv,Slovenian,slv_Latn,sl_SI,slv_Latn
som,Somali,som_Latn,,som_Latn
pbt,Southern Pashto,pbt_Arab,,
sot,Southern Sotho,sot_Latn,,
spa,Spanish,spa_Latn,es_MX,spa_Latn
lvs,Standard Latvian,lvs_Latn,lv_LV,lav_Latn
zsm,Standard Malay,zsm_Latn,,msa_Latn
bod,Standard Tibetan,bod_Tibt,,bod_Tibt
sun,Sundanese,sun_Latn,,
swh,Swahili,swh_Latn,sw_KE,swa_Latn
ssw,Swati,ssw_Latn,,ssw_Latn
swe,Swedish,swe_Latn,sv_SE,swe_Latn
tgl,Tagalog,tgl_Latn,,
tgk,Tajik,tgk_Cyrl,,tgk_Cyrl
tam,Tamil,tam_Taml,ta_IN,tam_Taml
tel,Telugu,tel_Telu,te_IN,tel_Telu
tha,Thai,tha_Thai,th_TH,tha_Thai
tir,Tigrinya,tir_Ethi,,tir_Ethi
als,Tosk Albanian,als_Latn,,sqi_Latn
tso,Tsonga,tso_Latn,,
tsn,Tswana,tsn_Latn,,tsn_Latn
tur,Turkish,tur_Latn,tr_TR,tur_Latn
twi,Twi,twi_Latn,,
ukr,Ukrainian,ukr_Cyrl,uk_UA,ukr_Cyrl
urd,Urdu,urd_Arab,ur_PK,urd_Arab
vie,Vietnamese,vie_Latn,vi_VN,vie_Latn
war,Waray,war_Latn,,
cym,Welsh,cym_Latn,,cym_Latn
gaz,West Central Oromo,gaz_Latn,,orm_Ethi
pes,Western Persian,pes_Arab,fa_IR,
wol,Wolof,wol_Latn,,wol_Latn
xho,Xhosa,xho_Latn,,xho_Latn
yor,Yorùbá,yor_Latn,,yor_Latn
zul,Zulu,zul_Latn,zu_ZA,zul_Latn
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: language-code alias maps (map_name, raw_code, lang_code),
# 128 rows: irokobench 2, global_mmlu 14, okapi 31, include 44, iso 37.
# ---------------------------------------------------------------------------
ALIASES_CSV = """\
irokobench,swa,swh
irokobench,orm,gaz
global_mmlu,bn,ben
global_mmlu,zh,zho
global_mmlu,fr,fra
global_mmlu,de,deu
global_mmlu,hi,hin
global_mmlu,id,ind
global_mmlu,it,ita
global_mmlu,ja,jpn
global_mmlu,ko,kor
global_mmlu,ar,arb
global_mmlu,pt,por
global_mmlu,es,spa
global_mmlu,sw,swh
global_mmlu,yo,yor
okapi,ar,arb
okapi,bn,ben
okapi,ca,cat
okapi,da,dan
okapi,de,deu
okapi,es,spa
okapi,eu,eus
okapi,fr,fra
okapi,gu,guj
okapi,hi,hin
okapi,hr,hrv
okapi,hu,hun
okapi,hy,hye
okapi,id,ind
okapi,it,ita
okapi,kn,kan
okapi,ml,mal
okapi,mr,mar
okapi,ne,npi
okapi,nl,nld
okapi,pt,por
okapi,ro,ron
okapi,ru,rus
okapi,sr,srp
okapi,sk,slk
okapi,sv,swe
okapi,ta,tam
okapi,te,tel
okapi,uk,ukr
okapi,vi,vie
okapi,zh,zho
include,albanian,als
include,arabic,arb
include,armenian,hye
include,azerbaijani,azj
include,basque,eus
include,belarusian,bel
include,bengali,ben
include,bulgarian,bul
include,chinese,zho
include,croatian,hrv
include,dutch,nld
include,estonian,est
include,finnish,fin
include,french,fra
include,georgian,kat
include,german,deu
include,greek,ell
include,hebrew,heb
include,hindi,hin
include,hungarian,hun
include,indonesian,ind
include,italian,ita
include,japanese,jpn
include,kazakh,kaz
include,korean,kor
include,lithuanian,lit
include,malay,zsm
include,malayalam,mal
include,nepali,npi
include,north macedonian,mkd
include,persian,pes
include,polish,pol
include,portuguese,por
include,russian,rus
include,serbian,srp
include,spanish,spa
include,tagalog,tgl
include,tamil,tam
include,telugu,tel
include,turkish,tur
include,ukrainian,ukr
include,urdu,urd
include,uzbek,uzn
include,vietnamese,vie
iso,ar,arb
iso,bn,ben
iso,ca,cat
iso,da,dan
iso,de,deu
iso,es,spa
iso,eu,eus
iso,fr,fra
iso,gu,guj
iso,hi,hin
iso,hr,hrv
iso,hu,hun
iso,hy,hye
iso,id,ind
iso,it,ita
iso,ja,jpn
iso,kn,kan
iso,ko,kor
iso,ml,mal
iso,mr,mar
iso,ne,npi
iso,nl,nld
iso,pt,por
iso,ro,ron
iso,ru,rus
iso,sr,srp
iso,sk,slk
iso,sv,swe
iso,sw,swh
iso,ta,tam
iso,te,tel
iso,th,tha
iso,tr,tur
iso,uk,ukr
iso,vi,vie
iso,yo,yor
iso,zh,zho
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: benchmark extraction rules, in extraction order.
# benchmark, task pattern (group 1 = language, group 2 = script if any),
# metric key, fallback metric key (taken when the first is null or 0),
# excluded (English) code, alias map, alias policy.
#   override : map only the codes listed, keep the rest unchanged
#   drop     : keep only codes that the map knows
#   pass     : map when known, otherwise keep the raw code
# ---------------------------------------------------------------------------
RULES = [
    ("afrimmlu", r"^afrimmlu_direct_([a-z]+)_prompt_1$", "acc,none", None, "eng", "irokobench", "override"),
    ("afrixnli", r"^afrixnli_([a-z]+)_prompt_2$", "acc,none", None, "eng", "irokobench", "override"),
    ("belebele", r"^belebele_([a-z]+)_([A-Za-z]+)$", "acc,none", None, "eng", None, "script"),
    ("global_mmlu", r"^global_mmlu_([a-z]{2})$", "acc,none", None, "en", "global_mmlu", "drop"),
    ("hellaswag", r"^hellaswag_([a-z]{2})$", "acc_norm,none", "acc,none", "en", "okapi", "pass"),
    ("truthfulqa", r"^truthfulqa_([a-z]{2})_mc2$", "acc,none", None, "en", "okapi", "pass"),
    ("mgsm", r"^mgsm_direct_([a-z]{2})$", "exact_match,flexible-extract", None, "en", "iso", "pass"),
    ("mlqa", r"^mlqa_en_([a-z]{2})$", "f1,none", None, "en", "iso", "pass"),
    ("include", r"^include_base_44_([a-z ]+)$", "acc,none", None, None, "include", "drop"),
]
BENCHMARKS = [r[0] for r in RULES]

# FIXED VALUES: the one script rule of belebele (language, script -> code).
SCRIPT_OVERRIDES = [("zho", "Hant", "zho_trad")]

# ---------------------------------------------------------------------------
# FIXED VALUES: sampling parameters per model family; None = not set.
# family, temperature, top_p, top_k, max_tokens
# ---------------------------------------------------------------------------
SAMPLING = [
    ("gemma", 1.0, 0.95, 64, 1024),
    ("qwen", 0.7, 0.8, 20, 1024),
    ("deepseek", 0.6, 0.95, None, 1024),
    ("llama", 0.6, 0.9, None, 1024),
    ("mistral", 0.15, None, None, 1024),
    ("phi", 0.8, 0.95, None, 1024),
]
SAMPLING_FALLBACK = (0.7, None, None, 1024)

# ---------------------------------------------------------------------------
# FIXED VALUES: prompt templates ({name} = target language name,
# {text} = English source). "thinking_off" is used when the model's chat
# template accepts the switch, "plain" otherwise.
# ---------------------------------------------------------------------------
PROMPT_TEMPLATES = {
    "thinking_off": "Translate the following sentence into {name}. Do not output any other text.\nEnglish: {text}\n{name}:",
    "plain": "Translate to {name}. Output only the translation.\nEnglish: {text}\n{name}:",
}

# FIXED VALUES: parallel corpora: dataset, split, drop leading row, code column.
DATASETS = [
    ("flores-200", "devtest", False, "flores_code"),
    ("wmt24", "train", True, "wmt_code"),
    ("ntrex", "test", False, "ntrex_code"),
]
SOURCE_LANG = "eng"

# Metric columns of the metric table, with their output rounding (digits).
METRIC_COLUMNS = [
    ("bleu", 2), ("chrf", 2), ("rouge_l", 4), ("meteor", 4),
    ("xcomet", 4), ("ssa_comet", 4), ("metricx", 4),
]
METRICX_OFFSET = 25.0


def _rows(text: str) -> list[list[str]]:
    return [r for r in csv.reader(io.StringIO(text)) if r]


def _nz(v: str):
    return v if v != "" else None


def models_df(spark: SparkSession, variants: dict[str, str] | None = None) -> DataFrame:
    """The model registry. ``prompt_variant`` picks the prompt template per
    model ('thinking_off' unless the model's chat template rejects that
    switch, then 'plain'); which templates do is known only at run time, so it
    is a parameter."""
    variants = variants or {}
    schema = T.StructType([
        T.StructField("model", T.StringType(), False),
        T.StructField("hub_path", T.StringType(), False),
        T.StructField("family", T.StringType(), False),
        T.StructField("tp", T.IntegerType(), False),
        T.StructField("in_benchmark", T.BooleanType(), False),
        T.StructField("in_translation", T.BooleanType(), False),
        T.StructField("in_backfill", T.BooleanType(), False),
        T.StructField("translation_dir", T.StringType(), False),
        T.StructField("prompt_variant", T.StringType(), False),
    ])
    data = [(m, h, f, int(tp), b == "1", t == "1", k == "1", d, variants.get(m, "thinking_off"))
            for m, h, f, tp, b, t, k, d in _rows(MODELS_CSV)]
    return spark.createDataFrame(data, schema)


def canonical_model(col):
    """A model's registry name, however a stage spells it: the registry's name or
    the translation folder's, without regard to case. Unknown names stay."""
    from pyspark.sql import functions as F
    c = F.col(col) if isinstance(col, str) else col
    names = {s.lower(): r[0] for r in _rows(MODELS_CSV) for s in (r[0], r[7])}
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(known[F.lower(c)], c)


def languages_df(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("lang_code", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("flores_code", T.StringType(), True),
        T.StructField("wmt_code", T.StringType(), True),
        T.StructField("ntrex_code", T.StringType(), True),
    ])
    data = [(c, n, _nz(f), _nz(w), _nz(x)) for c, n, f, w, x in _rows(LANGUAGES_CSV)]
    return spark.createDataFrame(data, schema)


def aliases_df(spark: SparkSession) -> DataFrame:
    schema = "map_name string, raw_code string, lang_code string"
    return spark.createDataFrame([tuple(r) for r in _rows(ALIASES_CSV)], schema)


def sampling_df(spark: SparkSession) -> DataFrame:
    schema = "family string, temperature double, top_p double, top_k int, max_tokens int"
    return spark.createDataFrame(SAMPLING, schema)


def alias_pairs(map_name: str) -> list[tuple[str, str]]:
    return [(raw, code) for m, raw, code in _rows(ALIASES_CSV) if m == map_name]
