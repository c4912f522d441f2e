"""Census of bilingual topics over whole texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Topic and pattern, matched without case.
TOPICS = {
    "soil_classification_genesis": r"классификац|генезис почв|soil classif|soil genesis|WRB|почвообразован",
    "organic_carbon_humus": r"органическ.{0,12}углерод|гумус|soil organic carbon|organic matter|carbon stock",
    "microbiology_biology": r"микроб|бактери|гриб|фермент|microb|bacter|fung|enzyme activ",
    "cryogenesis_permafrost": r"криоген|мерзлот|вечн.{0,8}мерз|permafrost|cryogenic|cryosol|freeze.thaw",
    "podzolization_alfe_humus": r"подзол|Al.?Fe.?гумус|podzol|retisol|eluviat|illuviat",
    "hydromorphism_gley": r"\bгле(?:й|ев|ист|изац)|гидроморф|заболоч|переувлаж|gley|hydromorph|waterlog",
    "salinity_solonetz": r"засолен|солонч|солонец|солонц|salin|solonetz|\bsodic\b",
    "chernozem_steppe": r"черноз|степн.{0,8}почв|chernozem|steppe soil",
    "peat_wetlands": r"торф|болот|peat|histosol|wetland|mire",
    "agriculture_tillage_fertilization": r"пашн|агроцен|удобрен|земледел|обработк.{0,8}почв|cropland|tillage|fertiliz|agricultur",
    "forest_soils": r"лесн.{0,8}почв|forest soil|forest ecosystem|под пологом лес",
    "erosion_degradation": r"эрози|деградац|дефляц|erosion|soil degradation|desertif",
    "contamination_metals": r"загрязнен|тяжел.{0,8}металл|нефт|радионук|contamin|heavy metal|pollut|oil spill",
    "urban_technogenic": r"городск.{0,8}почв|урбан|техноген|urban soil|technosol|technogenic",
    "climate_change_warming": r"изменен.{0,8}климат|потеплен|climate change|warming|drought",
    "fire_pyrogenesis": r"пожар|пироген|горельник|wildfire|post.?fire|pyrogen",
    "nitrogen_cycle": r"азотн.{0,8}цикл|минерализац.{0,8}азот|нитрификац|nitrogen cycle|nitrif|denitrif",
    "phosphorus_cycle": r"фосфорн.{0,8}цикл|фосфат|phosphorus|phosphate",
    "soil_ph_acidity": r"кислотност.{0,8}почв|pH.{0,12}почв|soil pH|soil acidity|обменн.{0,8}кислот",
    "soil_structure_physics": r"структурн.{0,8}состоя|агрегат|плотност.{0,8}сложен|пористост|soil structure|aggregate|bulk density|porosity",
    "hydrology_moisture": r"водн.{0,8}режим|влажност.{0,8}почв|гидролог|soil moisture|water regime|hydrolog",
    "paleosols_archives": r"палеопоч|палеогеограф|погребенн.{0,8}почв|paleosol|palaeosol|paleogeograph|buried soil",
    "remote_sensing_mapping": r"дистанцион|картограф|цифров.{0,8}карт|remote sensing|digital soil map|soil mapping",
}


def text_topics(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_col, topic): every topic of each id, once. Whole texts are searched; null and empty ones have no topic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [(name, re.compile(p, re.I | re.S)) for name, p in TOPICS.items()]
        for batch in batches:
            at, topic = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                focus = (text or "").casefold()
                for name, pattern in patterns:
                    if focus and pattern.search(focus):
                        at.append(i)
                        topic.append(name)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(topic, pa.string())], names=[id_col, "topic"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, topic string").distinct()
