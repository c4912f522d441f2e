"""Values of the domain rules."""

# Allowed range of a property and the rule's name; densities and contents need a proven unit.
PHYSICAL_RANGE: dict[str, tuple[float, float, str]] = {
    "ph_h2o": (2.0, 12.0, "soil pH 2–12"),
    "ph_kcl": (2.0, 12.0, "soil pH 2–12"),
    "ph_unspecified": (2.0, 12.0, "soil pH 2–12"),
    "bulk_density": (0.05, 2.65, "bulk density 0.05–2.65 g/cm3"),
    "particle_density": (1.0, 4.0, "particle density 1.0–4.0 g/cm3"),
    "soil_organic_carbon": (0.0, 600.0, "organic carbon content 0–600 g/kg (Histosol ceiling)"),
    "total_nitrogen": (0.0, 50.0, "total nitrogen content 0–50 g/kg"),
    "total_potassium": (0.0, 60.0, "total potassium content 0–60 g/kg"),
    "soil_depth": (0.0, 2000.0, "soil depth 0–2 000 cm"),
    "flow_depth": (0.0, 2000.0, "flow depth 0–2 000 cm"),
    "layer_depth": (0.0, 2000.0, "layer depth 0–2 000 cm"),
    "soil_moistening_depth": (0.0, 2000.0, "soil moistening depth 0–2 000 cm"),
    "leaf_length": (0.0, 2000.0, "leaf length 0–2 000 mm"),
    "root_length": (0.0, 2000.0, "root length 0–2 000 mm"),
    "iron": (0.0, 300000.0, "iron content 0–300 000 mg/kg (30% mass ceiling)"),
    "zinc": (0.0, 50000.0, "zinc content 0–50 000 mg/kg"),
    "copper": (0.0, 50000.0, "copper content 0–50 000 mg/kg"),
    "nickel": (0.0, 50000.0, "nickel content 0–50 000 mg/kg"),
    "manganese": (0.0, 50000.0, "manganese content 0–50 000 mg/kg"),
    "mercury": (0.0, 1000.0, "mercury content 0–1 000 mg/kg"),
    "nitrate_n": (0.0, 5000.0, "nitrate nitrogen 0–5 000 mg/kg"),
    "mineral_nitrogen": (0.0, 5000.0, "mineral nitrogen 0–5 000 mg/kg"),
    "available_phosphorus": (0.0, 20000.0, "available phosphorus 0–20 000 mg/kg"),
    "total_dissolved_solids": (0.0, 500.0, "total dissolved solids 0–500 g/L (saturated brine ceiling)"),
    "calcium": (0.0, 100.0, "exchangeable calcium 0–100 cmolc/kg"),
    "magnesium": (0.0, 100.0, "exchangeable magnesium 0–100 cmolc/kg"),
    "calcium_ion": (0.0, 200.0, "soil-solution ion 0–200 meq/100g"),
    "magnesium_ion": (0.0, 200.0, "soil-solution ion 0–200 meq/100g"),
    "sodium_ion": (0.0, 200.0, "soil-solution ion 0–200 meq/100g"),
    "potassium_ion": (0.0, 200.0, "soil-solution ion 0–200 meq/100g"),
    "chloride_ion": (0.0, 200.0, "soil-solution ion 0–200 meq/100g"),
    "sulfate_ion": (0.0, 200.0, "soil-solution ion 0–200 meq/100g"),
    "bicarbonate_ion": (0.0, 200.0, "soil-solution ion 0–200 meq/100g"),
    "hydrogen_ion": (0.0, 200.0, "soil-solution ion 0–200 meq/100g"),
    "ammonium_ion": (0.0, 200.0, "soil-solution ion 0–200 meq/100g"),
}
# Properties that are percentages of a whole, and the name of their rule.
PERCENT_PROPERTIES = (
    "sand",
    "coarse_sand",
    "fine_sand",
    "silt",
    "clay",
    "physical_clay",
    "porosity",
    "base_saturation",
    "aggregate_stability",
    "organic_matter",
    "carbonate_equivalent",
    "exchangeable_sodium_percentage",
    "gravimetric_water_content",
    "field_capacity",
    "wilting_point",
    "water_holding_capacity",
    "vegetation_pole_density",
    "soil_cover_percentage",
    "coarse_silt",
    "medium_silt",
    "fine_silt",
    "very_coarse_sand",
    "fine_fraction_lt_0_001mm",
    "silicon_dioxide",
    "iron_oxide_fe2o3",
    "aluminum_oxide_al2o3",
    "calcium_oxide_cao",
    "magnesium_oxide_mgo",
    "potassium_oxide_k2o",
    "sodium_oxide_na2o",
    "titanium_dioxide",
    "manganese_oxide_mno",
    "phosphorus_pentoxide",
    "potassium_oxide",
)
PERCENT_RULE = "percentage 0–100"
# Range of unclassified metrics by unit.
UNIT_RANGE: dict[str, tuple[float, float, str]] = {
    "cm": (0.0, 2000.0, "generic length 0–2 000 cm"),
    "mm": (0.0, 2000.0, "generic length 0–2 000 mm"),
    "%": (0.0, 100.0, "percentage 0–100"),
    "mg/kg": (0.0, 300000.0, "generic concentration 0–300 000 mg/kg"),
    "°c": (-100.0, 100.0, "temperature −100–100 °C"),
    "в°c": (-100.0, 100.0, "temperature −100–100 °C"),
}
# Categories whose values cannot be negative, and the properties that can.
CONTENT_CATEGORIES = (
    "organic",
    "macronutrient",
    "exchange",
    "particle_size",
    "microelement",
    "contaminant",
    "salinity",
    "biological",
    "hydrophysical",
    "elemental_oxide",
    "soil_solution",
    "geochemical",
    "vegetation",
    "erosion",
    "hydrological",
    "hydrometeorological",
)
SIGNED_PROPERTIES = ("redox_potential", "soil_temperature")
NEGATIVE_RULE = "content cannot be negative"
NO_VALUE_RULE = "no numeric value"
# Properties for which a percentage becomes g/kg.
PERCENT_TO_G_KG = (
    "soil_organic_carbon",
    "total_nitrogen",
    "total_phosphorus",
    "total_potassium",
    "inorganic_carbon",
)
# Properties for which g/kg becomes a percentage.
G_KG_TO_PERCENT = (
    "organic_matter",
    "carbonate_equivalent",
    "base_saturation",
    "porosity",
    "sand",
    "silt",
    "clay",
    "field_capacity",
    "wilting_point",
    "water_holding_capacity",
)
# Spellings of units that are taken as one, without blanks and in small letters.
UNIT_FORMS = {
    "mg/kg": "mg/kg",
    "g/kg": "g/kg",
    "%": "%",
    "ds/m": "dS/m",
    "g/cm3": "g/cm3",
    "cmol(c)/kg": "cmolc/kg",
    "cmolc/kg": "cmolc/kg",
}
# Horizon prefix, the depth range that must follow it, and labels that are no horizons.
HORIZON_PREFIX = r"(?iuU)^[\[\(]?(?:O|H|A|AE|E|EL|BT|B|BC|C|R|AY|AУ|АY|АЕ|А|В|С|D)[0-9a-zа-я’′˙.]{0,6}[\]\)]?"
HORIZON_TAIL = r"^[\s,;|/()\[\]~*\"'’′-]{0,6}\d+\s*[–—-]\s*\d+"
HORIZON_REJECT = (
    "Bismuth",
    "Burozem",
    "Clay",
    "Contro",
    "Control",
    "Ditto",
    "High",
    "Object",
    "Высокие",
    "Am.s.",
    "Oc.l.",
    "A304",
    "AlCl3",
    "CATq",
    "C0rr",
    "RZAM",
)
# Words that name a coordinate datum, the most specific first.
DATUM_PATTERNS = (
    ("WGS-84", r"WGS[\s-]?84"),
    ("SK-42", r"СК[\s-]?42"),
    ("SK-95", r"СК[\s-]?95"),
    ("PZ-90", r"ПЗ[\s-]?90"),
    ("GSK-2011", r"ГСК[\s-]?2011"),
    ("Pulkovo", r"Пулков\w*"),
)
# Chemical symbols that name a property.
SYMBOLS = {
    "calcium": "Ca",
    "magnesium": "Mg",
    "zinc": "Zn",
    "copper": "Cu",
    "iron": "Fe",
    "manganese": "Mn",
    "boron": "B",
    "molybdenum": "Mo",
    "cobalt": "Co",
    "nickel": "Ni",
    "chromium": "Cr",
    "lead": "Pb",
    "cadmium": "Cd",
    "arsenic": "As",
    "mercury": "Hg",
    "selenium": "Se",
}
# Words that may stand beside a symbol.
SYMBOL_QUALIFIERS = (
    "total",
    "exchangeable",
    "mobile",
    "available",
    "soluble",
    "extractable",
    "content",
    "bulk",
    "gross",
    "heavy",
    "metals",
    "metal",
    "acid",
    "water",
    "dtpa",
    "edta",
    "aab",
    "hms",
    "hm",
    "dry",
    "matter",
    "soil",
    "horizon",
    "of",
    "in",
    "the",
    "and",
    "per",
    "общ",
    "подв",
    "обм",
    "вал",
    "содержание",
    "почв",
    "сух",
    "по",
    "в",
)
# Units as they stand in table headers and cells.
HEADER_UNIT = (
    r"(?:mg\s*(?:CO2|TPF|NH4-N|PNP)?\s*/\s*kg\s*/\s*(?:day|d|h)|мг\s*/\s*кг\s*/\s*(?:сут|ч)|cmol\(?c?\)\s*/\s*kg|ммоль\s*/\s*кг|mmol\s*/\s*kg|mg\s*/\s*kg|мг\s*/\s*кг|g\s*/\s*kg|г\s*/\s*кг"
    r"|g\s*/\s*l|г\s*/\s*л|mg\s*/\s*l|мг\s*/\s*л|g\s*/\s*cm[³3]|г\s*/\s*см[³3]|cm\s*/\s*(?:day|d|h)|см\s*/\s*(?:сут|ч)|mS\s*/\s*cm|µS\s*/\s*cm|uS\s*/\s*cm|dS\s*/\s*m|S\s*/\s*m|MPa|kPa|mV|°\s*C|%|pH)"
)
# Header phrase of each property, in the order of the tests.
HEADER_PATTERNS = (
    ("ph_kcl", r"(?:\b[pр]\s*[hн]\s*(?:\(?\s*KCl\s*\)?|in\s*KCl|KCl\s*solution)|[pр]\s*[hн]\s*(?:сол\w*|KCl))"),
    ("ph_h2o", r"(?:\b[pр]\s*[hн]\s*(?:\(?\s*H[₂2]O\s*\)?|in\s*water|water|водн\w*)|water\s+[pр]\s*[hн])"),
    ("ph_unspecified", r"\b[pр]\s*[hн]\b"),
    ("exchangeable_acidity", r"exchangeable\s+acidity|гидролитическ\w*\s+кислотност|обменн\w*\s+кислотност"),
    ("exchangeable_hydrogen", r"exchangeable\s+H(?:ydrogen)?|обменн\w*\s+водород"),
    ("electrical_conductivity", r"electrical\s+conductiv|\bEC\b|электропроводност"),
    ("total_dissolved_solids", r"total\s+dissolved\s+solids|\bTDS\b|сумм\w*\s+растворенн\w*\s+веществ"),
    ("sodium_adsorption_ratio", r"sodium\s+adsorption\s+ratio|\bSAR\b"),
    ("exchangeable_sodium_percentage", r"exchangeable\s+sodium\s+percentage|\bESP\b|обменн\w*\s+натри\w*\s*%"),
    ("soil_organic_carbon", r"soil\s+organic\s+carbon|organic\s+carbon|\bSOC\b|\bC[_ ]?org\b|органическ\w*\s+углерод|С\s*орг"),
    ("organic_matter", r"organic\s+matter|\bOM\b|humus|гумус|органическ\w*\s+веществ"),
    ("inorganic_carbon", r"inorganic\s+carbon|\bIC\b|неорганическ\w*\s+углерод"),
    ("carbonate_equivalent", r"carbonate\s+equivalent|CaCO[₃3]|карбонат\w*\s+эквивалент"),
    ("total_nitrogen", r"total\s+(?:N\b|nitrogen)|\bN[_ ]?total\b|общ\w*\s+азот|\bNобщ\b"),
    ("nitrate_n", r"nitrate(?:[- ]?N)?|\bNO[₃3][-– ]?N\b|нитрат"),
    ("ammonium_n", r"ammonium(?:[- ]?N)?|\bNH[₄4][-– ]?N\b|аммони"),
    ("mineral_nitrogen", r"mineral\s+nitrogen|минеральн\w*\s+азот"),
    ("total_phosphorus", r"total\s+(?:P\b|phosphorus)|общ\w*\s+фосфор"),
    ("available_phosphorus", r"available\s+(?:P\b|phosphorus)|mobile\s+phosphorus|P[₂2]O[₅5]|подвижн\w*\s+фосфор"),
    ("total_potassium", r"total\s+(?:K\b|potassium)|общ\w*\s+кали"),
    ("available_potassium", r"available\s+(?:K\b|potassium)|mobile\s+potassium|K[₂2]O|подвижн\w*\s+кали"),
    ("available_sulfur", r"available\s+sulfur|mobile\s+sulfur|подвижн\w*\s+сер"),
    ("sulfur", r"\btotal\s+S\b|\bsulfur\b|\bS\s*,?\s*mg|общ\w*\s+сер"),
    ("cation_exchange_capacity", r"cation\s+exchange\s+capacity|\bCEC\b|ёмкост\w*\s+катионн\w*\s+обмен"),
    ("base_saturation", r"base\s+saturation|\bBS\s*%|степен\w*\s+насыщенн\w*\s+основан"),
    ("potassium_exchangeable", r"exchangeable\s+(?:K\b|potassium)|обменн\w*\s+кали"),
    ("sodium", r"exchangeable\s+(?:Na\b|sodium)|обменн\w*\s+натри"),
    ("aluminium_exchangeable", r"exchangeable\s+(?:Al\b|aluminium|aluminum)|обменн\w*\s+алюмин"),
    ("coarse_sand", r"(?<![\d.,])1(?:[.,]0+)?\s*[-–—]\s*0[.,]25\s*(?:мм|mm)?(?![\d.,])"),
    ("fine_sand", r"(?<![\d.,])0[.,]25\s*[-–—]\s*0[.,]05\s*(?:мм|mm)?(?![\d.,])"),
    ("physical_clay", r"physical\s+clay|физическ\w*\s+глин|<\s*0[.,]01\s*(?:мм|mm)?(?![\d.,])"),
    ("sand", r"\bsand\b|пес(?:ок|чан)"),
    ("silt", r"\bsilt\b|пылеват"),
    ("clay", r"\bclay\b|глинист"),
    ("bulk_density", r"bulk\s+density|dry\s+bulk\s+density|плотност\w*\s+сложения"),
    ("particle_density", r"particle\s+density|specific\s+gravity|плотност\w*\s+тв[её]рд\w*\s+фаз"),
    ("porosity", r"(?:total\s+)?porosity|пористост"),
    ("aggregate_stability", r"aggregate\s+stability|water[- ]stable\s+aggregates|агрегатн\w*\s+устойчивост"),
    ("penetration_resistance", r"penetration\s+resistance|soil\s+resistance|пенетрационн\w*\s+сопротивлен"),
    ("gravimetric_water_content", r"gravimetric\s+water|soil\s+moisture|влажност\w*\s+почв"),
    ("field_capacity", r"field\s+capacity|\bFC\b|наименьш\w*\s+влаго[её]мкост"),
    ("wilting_point", r"wilting\s+point|\bWP\b|влажност\w*\s+завядан"),
    ("water_holding_capacity", r"water[- ]holding\s+capacity|\bWHC\b|влаго[её]мкост"),
    ("saturated_hydraulic_conductivity", r"(?:saturated\s+)?hydraulic\s+conductivity|\bKsat\b|коэффициент\w*\s+фильтрац"),
    ("microbial_biomass_carbon", r"microbial\s+biomass\s+(?:C\b|carbon)|\bMBC\b|микробн\w*\s+биомасс\w*\s+углерод"),
    ("microbial_biomass_nitrogen", r"microbial\s+biomass\s+(?:N\b|nitrogen)|\bMBN\b|микробн\w*\s+биомасс\w*\s+азот"),
    ("basal_respiration", r"basal\s+(?:soil\s+)?respiration|\bBR\b|базальн\w*\s+дыхани"),
    ("dehydrogenase_activity", r"dehydrogenase|дегидрогеназ"),
    ("urease_activity", r"urease|уреаз"),
    ("phosphatase_activity", r"phosphatase|фосфатаз"),
    ("redox_potential", r"redox\s+potential|\bEh\b|окислительно[- ]восстановительн\w*\s+потенциал"),
    ("soil_temperature", r"soil\s+temperature|температур\w*\s+почв"),
    ("carbon_nitrogen_ratio", r"\bC\s*[/:]\s*N\b|\bC\s*к\s*N\b|отношени\w*\s*C\s*[/:]\s*N"),
    ("carbon_phosphorus_ratio", r"\bC\s*[/:]\s*P\b"),
    ("hydrogen_carbon_ratio", r"\bH\s*[/:]\s*C\b"),
    ("oxygen_carbon_ratio", r"\bO\s*[/:]\s*C\b"),
    ("silicon_dioxide", r"\bSiO\s*2\b"),
    ("aluminum_oxide_al2o3", r"\bAl\s*2\s*O\s*3\b"),
    ("iron_oxide_fe2o3", r"\bFe\s*2\s*O\s*3\b"),
    ("titanium_dioxide", r"\bTiO\s*2\b"),
    ("manganese_oxide_mno", r"\bMnO\b(?!\s*2)"),
    ("calcium_oxide_cao", r"\bCaO\b"),
    ("magnesium_oxide_mgo", r"\bMgO\b"),
    ("potassium_oxide_k2o", r"\bK\s*2\s*O\b"),
    ("sodium_oxide_na2o", r"\bNa\s*2\s*O\b"),
    ("phosphorus_pentoxide", r"\bP\s*2\s*O\s*5\b"),
    ("very_coarse_sand", r"(?<![\d.,])[31](?:[.,]0+)?\s*[-–—]\s*1(?:[.,]0+)?\s*(?:мм|mm)?(?![\d.,])"),
    ("coarse_silt", r"(?<![\d.,])0[.,]05\s*[-–—]\s*0[.,]01\s*(?:мм|mm)?(?![\d.,])"),
    ("medium_silt", r"(?<![\d.,])0[.,]01\s*[-–—]\s*0[.,]005\s*(?:мм|mm)?(?![\d.,])"),
    ("fine_silt", r"(?<![\d.,])0[.,]005\s*[-–—]\s*0[.,]001\s*(?:мм|mm)?(?![\d.,])"),
    ("fine_fraction_lt_0_001mm", r"<\s*0[.,]001\s*(?:мм|mm)?(?![\d.,])"),
    ("exchangeable_calcium", r"exchangeable\s+(?:Ca\b|calcium)|обменн\w*\s+(?:Ca\b|кальци)"),
    ("exchangeable_magnesium", r"exchangeable\s+(?:Mg\b|magnesium)|обменн\w*\s+(?:Mg\b|магни)"),
    ("calcium_ion", r"\bCa\s*2?\s*\+"),
    ("magnesium_ion", r"\bMg\s*2?\s*\+"),
    ("sodium_ion", r"\bNa\s*\+"),
    ("potassium_ion", r"\bK\s*\+"),
    ("ammonium_ion", r"\bNH\s*4\s*\+"),
    ("aluminium_ion", r"\bAl\s*3?\s*\+"),
    ("hydrogen_ion", r"\bH\s*\+"),
    ("bicarbonate_ion", r"\bHCO\s*3\s*[-−]"),
    ("carbonate_ion", r"\bCO\s*3\s*2?\s*[-−]"),
    ("sulfate_ion", r"\bSO\s*4\s*2?\s*[-−]"),
    ("chloride_ion", r"\bCl\s*[-−]"),
    ("nitrate_ion", r"\bNO\s*3\s*[-−]"),
)
# Property of a header key, as curated by hand.
CURATED_HEADERS = {
    "humus": "organic_matter",
    "humus %": "organic_matter",
    "humus, %": "organic_matter",
    "corg": "soil_organic_carbon",
    "corg, %": "soil_organic_carbon",
    "corg %": "soil_organic_carbon",
    "organic carbon": "soil_organic_carbon",
    "bulk density, g/cm3": "bulk_density",
    "bulk density g/cm3": "bulk_density",
    "clay": "clay",
    "clay, %": "clay",
    "silt": "silt",
    "silt, %": "silt",
    "sand": "sand",
    "sand, %": "sand",
    "cec": "cation_exchange_capacity",
    "p2o5": "phosphorus_pentoxide",
    "k2o": "potassium_oxide_k2o",
    "cao": "calcium_oxide_cao",
    "mgo": "magnesium_oxide_mgo",
    "al2o3": "aluminum_oxide_al2o3",
    "sio2": "silicon_dioxide",
    "fe2o3": "iron_oxide_fe2o3",
    "c/n": "carbon_nitrogen_ratio",
    "c:n": "carbon_nitrogen_ratio",
    "mg2+": "magnesium_ion",
    "ca2+": "calcium_ion",
    "na+": "sodium_ion",
    "k+": "potassium_ion",
    "h+": "hydrogen_ion",
    "cl-": "chloride_ion",
    "so42-": "sulfate_ion",
    "hco3-": "bicarbonate_ion",
    "mg": "magnesium",
    "ca": "calcium",
    "na": "sodium",
    "fe": "iron",
    "co": "cobalt",
    "ph": "ph_unspecified",
    "ph water": "ph_h2o",
    "phwater": "ph_h2o",
    "ph h2o": "ph_h2o",
    "phkcl": "ph_kcl",
    "ph kcl": "ph_kcl",
    "ec": "electrical_conductivity",
    "ec, conc. 1-1%": "electrical_conductivity",
    "tio2": "titanium_dioxide",
    "na2o": "sodium_oxide_na2o",
    "mno": "manganese_oxide_mno",
    "cr": "chromium",
    "as": "arsenic",
    "mn": "manganese",
    "zn": "zinc",
    "total s": "sulfur",
    "total p": "total_phosphorus",
    "wp": "wilting_point",
    "br": "basal_respiration",
    "cec saturation": "base_saturation",
    "caco3": "carbonate_equivalent",
    "caco3, %": "carbonate_equivalent",
    "sar": "sodium_adsorption_ratio",
    "hg": "mercury",
    "ni": "nickel",
    "pb": "lead",
    "exchangeable na, % of the cec": "exchangeable_sodium_percentage",
    "na, % of cec": "exchangeable_sodium_percentage",
    "om": "organic_matter",
    "om, %": "organic_matter",
    "гумус": "organic_matter",
    "гумус, %": "organic_matter",
    "рн": "ph_unspecified",
    "рн kcl": "ph_kcl",
    "nh4+": "ammonium_ion",
    "mo": "molybdenum",
    "ec, ds/m": "electrical_conductivity",
    "ca co3 %": "carbonate_equivalent",
    "urease, mg nh3": "urease_activity",
    "cu": "copper",
    "al3+": "aluminium_ion",
    "fc": "field_capacity",
    "co32-": "carbonate_ion",
    "n-no3-": "nitrate_ion",
    "no3-": "nitrate_ion",
    "medium silt": "medium_silt",
    "fine silt": "fine_silt",
    "coarse silt": "coarse_silt",
    "n total": "total_nitrogen",
    "ntotal": "total_nitrogen",
    "soc": "soil_organic_carbon",
    "tds": "total_dissolved_solids",
    "tds, %": "total_dissolved_solids",
    "thickness of horizons, cm a + b": "horizon_thickness",
    "air capacity at the field capacity m": "air_capacity_field_capacity",
}
# Category, unit and pattern of properties named in prose.
PROSE_PROPERTIES = {
    "ph_h2o": ("acid_base", "pH", r"\bpH(?:\s*(?:H2O|водн(?:ый|ой)))?\b"),
    "electrical_conductivity": ("salinity", "dS/m", r"(?:electrical conductivity|электропроводност)"),
    "soil_organic_carbon": ("organic", "g/kg", r"(?:soil organic carbon|organic carbon|органическ[а-я ]{0,16}углерод|Сорг)"),
    "organic_matter": ("organic", "%", r"(?:organic matter|гумус)"),
    "total_nitrogen": ("macronutrient", "g/kg", r"(?:total nitrogen|общ(?:ий|его) азот|Nобщ)"),
    "nitrate_n": ("macronutrient", "mg/kg", r"(?:nitrate|нитрат)"),
    "ammonium_n": ("macronutrient", "mg/kg", r"(?:ammonium|аммоний)"),
    "available_phosphorus": ("macronutrient", "mg/kg", r"(?:available phosphorus|подвижн[а-я ]{0,14}фосфор|P2O5)"),
    "available_potassium": ("macronutrient", "mg/kg", r"(?:available potassium|подвижн[а-я ]{0,14}калий|K2O)"),
    "calcium": ("exchange", "cmolc/kg", r"(?:\bCa\b|кальци)"),
    "magnesium": ("exchange", "cmolc/kg", r"(?:\bMg\b|магни)"),
    "cation_exchange_capacity": ("exchange", "cmolc/kg", r"(?:cation exchange capacity|\bCEC\b|ёмкост[ьи] катионного обмена)"),
    "sand": ("particle_size", "%", r"(?:\bsand\b|пес(?:ок|чан))"),
    "silt": ("particle_size", "%", r"(?:\bsilt\b|пылеват)"),
    "clay": ("particle_size", "%", r"(?:\bclay\b|глинист)"),
    "bulk_density": ("physical", "g/cm3", r"(?:bulk density|плотност[ьи] сложения)"),
    "porosity": ("physical", "%", r"(?:porosity|пористост)"),
    "water_holding_capacity": ("hydrophysical", "%", r"(?:water holding capacity|влагоёмкост)"),
    "aggregate_stability": ("physical", "%", r"(?:aggregate stability|агрегатн[а-я ]{0,12}устойчивост)"),
    "microbial_biomass_carbon": ("biological", "mg/kg", r"(?:microbial biomass carbon|микробн[а-я ]{0,16}биомасс[а-я ]{0,8}углерод)"),
    "zinc": ("microelement", "mg/kg", r"(?:\bZn\b|цинк)"),
    "copper": ("microelement", "mg/kg", r"(?:\bCu\b|мед[ьи])"),
    "lead": ("contaminant", "mg/kg", r"(?:\bPb\b|свинец)"),
    "cadmium": ("contaminant", "mg/kg", r"(?:\bCd\b|кадми)"),
    "arsenic": ("contaminant", "mg/kg", r"(?:\bAs\b|мышьяк)"),
    "mercury": ("contaminant", "mg/kg", r"(?:\bHg\b|ртут)"),
}
# A quantity, a depth range and a horizon in prose.
PROSE_VALUE = r"(?<!\w)(-?\d+(?:[.,]\d+)?)\s*(mg\s*/\s*kg|мг\s*/\s*кг|g\s*/\s*kg|г\s*/\s*кг|%|cmol\(?c?\)\s*/\s*kg|dS\s*/\s*m|г\s*/\s*см[³3])"
PROSE_DEPTH = r"(\d+(?:[.,]\d+)?)\s*[–-]\s*(\d+(?:[.,]\d+)?)\s*(?:cm|см)"
PROSE_HORIZON = r"(?:горизонт|horizon)\s*([AEOBC][A-Za-z0-9+/.:-]{0,12})\b"
# Laboratory methods by the words that name them, without case.
METHODS = {
    "ph_potentiometric": r"potentiometr\w*|потенциометрическ\w*",
    "soc_tyurin": r"Тюрин\w*|Tyurin\w*",
    "soc_walkley_black": r"Walkley[ -]?Black",
    "soc_dry_combustion": r"dry combustion|elemental analy[sz]er|сух(?:ое|им) сжиган",
    "nitrogen_kjeldahl": r"Kjeldahl|Кьельдал",
    "nitrogen_dumas": r"\bDumas\b|Дюма",
    "phosphorus_olsen": r"\bOlsen\b|Ольсен",
    "phosphorus_bray": r"\bBray\b|Брэ[йи]",
    "mehlich_3": r"Mehlich[ -]?3|Мехлич",
    "chirikov": r"Чириков\w*|Chirikov\w*",
    "machigin": r"Мачигин\w*|Machigin\w*",
    "cec_ammonium_acetate": r"ammonium acetate|ацетат(?:а)? аммони",
    "particle_pipette": r"pipette method|пипеточн\w* метод",
    "particle_laser": r"laser diffraction|лазерн\w* дифракц",
    "metals_aas": r"atomic absorption|атомно-абсорбцион",
    "metals_icp_oes": r"ICP[ -]?(?:OES|AES)|индуктивно-связанн\w* плазм\w*",
    "metals_icp_ms": r"ICP[ -]?MS",
    "xrf": r"XRF|рентгенофлуоресцент",
    "loss_on_ignition": r"loss on ignition|потер[яи] при прокаливан",
}
# Administrative names in running text, with case.
PLACES = {
    "district": r"\b(?:[A-Z][A-Za-z\-]+(?:\s+[A-Z][A-Za-z\-]+){0,3}\s+(?:district|raion)|[А-ЯЁ][А-Яа-яЁё\-]+(?:\s+[А-ЯЁ][А-Яа-яЁё\-]+){0,3}\s+(?:район(?:е|а|у|ом)?))\b",
    "region": r"\b(?:[A-Z][A-Za-z\-]+(?:\s+[A-Z][A-Za-z\-]+){0,3}\s+(?:Oblast|Krai|Republic)|[А-ЯЁ][А-Яа-яЁё\-]+(?:\s+[А-ЯЁ][А-Яа-яЁё\-]+){0,3}\s+(?:област[ьи]|кра[ея]|республик[аи]))\b",
}
# Names of soils and of land use, without case.
DESCRIPTIONS = {
    "soil": (
        r"\b(?:Chernozem(?:ic)?|Phaeozem|Kastanozem|Retisol|Podzol(?:ic)?|Cambisol|Fluvisol|Gleysol|Leptosol|Solonetz|Solonchak|Arenosol|Histosol|Cryosol|"
        r"черноз[её]м(?:н\w*)?|дерново[- ]подзолист\w*|подзол\w*|каштанов\w*|солонц\w*|солончак\w*|аллювиальн\w*|сероз[её]м\w*|буроз[её]м\w*|торфян\w*|гле[её]в\w*|мерзлотн\w*)\b"
    ),
    "land_use": r"\b(?:arable land|cropland|pasture|grassland|forest(?:ed)?|fallow|orchard|пашн[яи]|сельскохозяйственн\w* угодь\w*|пастбищ\w*|сенокос\w*|лесн\w*|залеж\w*|сад\w*)\b",
}
# Words by which a place was studied; words of references and addresses; and words that outweigh these.
STUDY_CONTEXT = (
    r"\b(?:study (?:area|site)|research (?:was|has been)|soil (?:samples?|profiles?|pits?)|samples? (?:were|was) (?:collected|taken|analysed|analyzed)|field (?:site|study)|"
    r"sampling|investigated|examined|located|район исследования|исследуем\w*\s+(?:почв|участ)|почвенн\w*\s+(?:образц|разрез|профил)|отбор\w*\s+(?:почв|образц)|"
    r"образц\w*\s+почв|разрез\w*|профил\w*|почв\w*\s+(?:отобран|исследован|изучен)|исследован\w*\s+(?:почв|участ)|участк\w*\s+исследован)\b"
)
REFERENCE_CONTEXT = r"\b(?:references|литератур|bibliograph|doi\s*[:.]|e-?mail|принят[ао]? в редакц|поступил[ао]? в редакц|институт|university|академи[яи])\b|//"
SURE_CONTEXT = r"\b(?:район исследования|study area|samples? (?:were|was) (?:collected|taken)|отбор\w*|разрез\w*|profile|soil pit)\b"
