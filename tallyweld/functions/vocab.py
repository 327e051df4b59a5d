"""Word lists whose members decide results."""

#: Legal forms removed from company names, as whole words.
LEGAL_FORMS = ["SASU", "SAS", "SARL", "EURL", "SA", "SCI", "SNC", "SC", "SCA", "SCOP", "SELARL", "SELAFA", "GIE", "ASSOCIATION"]

#: Names that mean France.
FRANCE_NAMES = ["FRANCE", "FR", "FRA", "FRANCAIS", "FRANCAISE", "FRANÇAIS", "FRANÇAISE", "FRENCH", "FRANCE METROPOLITAINE", "METROPOLE", "METROPOLITAIN"]

#: Cities that are French.
FRENCH_CITIES = [
    "PARIS", "LYON", "MARSEILLE", "TOULOUSE", "NICE", "NANTES", "STRASBOURG", "MONTPELLIER", "BORDEAUX", "LILLE", "RENNES", "REIMS",
    "SAINT-ETIENNE", "TOULON", "LE HAVRE", "GRENOBLE", "DIJON", "ANGERS", "NIMES", "VILLEURBANNE", "SAINT-DENIS", "LE MANS",
    "AIX-EN-PROVENCE", "CLERMONT-FERRAND", "BREST", "LIMOGES", "TOURS", "AMIENS", "PERPIGNAN", "METZ", "BESANCON", "BOULOGNE-BILLANCOURT",
    "ORLEANS", "MULHOUSE", "ROUEN", "CAEN", "NANCY", "ARGENTEUIL", "ROUBAIX", "TOURCOING", "NANTERRE", "AVIGNON", "CRETEIL", "DUNKERQUE",
    "POITIERS", "ASNIERES-SUR-SEINE", "COURBEVOIE", "VERSAILLES", "VITRY-SUR-SEINE", "COLOMBES", "AULNAY-SOUS-BOIS", "LA COURNEUVE",
    "RUEIL-MALMAISON", "ANTIBES", "SAINT-MAUR-DES-FOSSES", "CANNES", "BOURGES", "MERIGNAC", "SAINT-NAZAIRE", "ISSY-LES-MOULINEAUX",
    "NOISY-LE-GRAND", "EVRY", "CHAMPIGNY-SUR-MARNE", "LEVALLOIS-PERRET", "ANTONY", "CLICHY", "IVRY-SUR-SEINE", "NEUILLY-SUR-SEINE",
    "SARCELLES", "PANTIN", "NOISY-LE-SEC", "LA ROCHELLE", "SAINT-OUEN", "CHAMBERY", "AUXERRE", "SETE", "BAYONNE", "BRIVE-LA-GAILLARDE",
    "FRECHES", "CHALON-SUR-SAONE", "MONTBELIARD", "CHARTRES", "VALENCE", "ARRAS", "BOULOGNE-SUR-MER", "CALAIS", "SAINT-BRIEUC", "ALBI",
    "MEAUX", "RODEZ", "AGEN", "TARBES", "PAU", "PERIGUEUX", "BRIVE", "TULLE", "GUERET", "MONTLUCON", "VIERZON", "CHATEAUROUX", "BLOIS",
    "DREUX", "VENDOME", "ROMORANTIN-LANTHENAY", "NOGENT-LE-ROTROU", "CHATEAUDUN", "GIEN", "MONTARGIS", "PITHIVIERS", "ETAMPES",
    "CORBEIL-ESSONNES", "MELUN", "FONTAINEBLEAU", "PROVINS", "COULOMMIERS", "TORCY", "MARNE-LA-VALLEE", "BRY-SUR-MARNE", "VINCENNES",
    "SAINT-MANDE", "FONTENAY-SOUS-BOIS", "NOGENT-SUR-MARNE", "LE PERREUX-SUR-MARNE", "NEUILLY-SUR-MARNE", "JOINVILLE-LE-PONT",
    "SAINT-MAURICE", "SUCY-EN-BRIE", "BOISSY-SAINT-LEGER", "LIMEIL-BREVANNES", "VALENTON", "BONNEUIL-SUR-MARNE",
    "LA VARENNE-SAINT-HILAIRE", "ORMESSON-SUR-MARNE",
]

#: Cities that are not French though a marker below would say so.
FOREIGN_CITIES = ["LA PAZ", "LAS VEGAS", "LOS ANGELES", "LA HABANA", "LA PLATA", "SANTA FE", "SANTA CRUZ", "SAN JOSE", "SAN FRANCISCO"]

#: Pieces of a name, anywhere in it, that mark a French city.
CITY_MARKERS = ["SAINT-", "SAINTE-", "LES ", "DU ", "DE LA ", "DES ", "SUR ", "SOUS ", "EN ", "ET ", "L'", "D'", "AUX ", "AU ", "LE HAVRE", "LE MANS", "LA ROCHELLE", "LA COURNEUVE"]

#: Accepted headings of each supplier column, first match wins.
COLUMN_ALIASES = {
    "Nom": ["NOM", "NAME", "NOM FOURNISSEUR", "SUPPLIER NAME", "COMPANY NAME", "RAISON SOCIALE"],
    "Postal": ["POSTAL", "CODE POSTAL", "CP", "ZIP", "ZIP CODE", "POSTCODE", "POSTAL CODE"],
    "Ville": ["VILLE", "CITY", "COMMUNE", "LOCALITE"],
    "Pays": ["PAYS", "COUNTRY", "PAYS FOURNISSEUR", "COUNTRY CODE"],
    "Code SIRET": ["CODE SIRET", "SIRET", "SIREN", "CODE SIREN"],
    "Date dern. Mouvt": ["DATE DERN. MOUVT", "DATE DERNIER MOUVEMENT", "LAST MOVEMENT DATE", "DATE DERN MOUVT", "DERNIER MOUVEMENT", "LAST MOVEMENT"],
}
