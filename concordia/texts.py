"""Sentences of the reports, as formats."""

# The wording (Hungarian) that readers of the reports rely on.

LEAD = "A %s alapú, %s időablakra és %s nézetre készített heti jelentés alapján"
LEAD_COUNTRY = "a legmarkánsabb országszintű elmozdulást %s mutatta, amelynek átlagos kapcsolatindexe %s ponttal változott, így összképe inkább %s irányba mozdult."
LEAD_PAIR = "A legerősebb országpár-szintű mozgás %s és %s között jelent meg, ahol a kapcsolatindex %s ponttal módosult."
LEAD_TOPIC = "Tematikus szinten a legerősebb újrarendeződés a(z) %s ügykörben látszott, ami arra utal, hogy ebben a dimenzióban történt a legnagyobb profilváltás."
LEAD_STABLE = "a vizsgált időszak összességében inkább stabil képet mutatott, csak korlátozott szerkezeti elmozdulásokkal."
DIRECTION = {"up": "erősödő", "down": "gyengülő", "flat": "stabil"}

COUNTRY = "%s országkapcsolati profilja %s: az átlagos kapcsolatindex %.2f-ről %.2f-re módosult (%s), miközben a hálózat %s járt együtt."
COUNTRY_DIRECTION = {"up": "erősödött", "down": "gyengült", "flat": "lényegében nem változott"}
COUNTRY_NETWORK = {"up": "szélesebb kapcsolati körrel", "down": "szűkülő partnerhálóval", "flat": "változatlan kapcsolatszámmal"}
PAIR = "%s és %s viszonyában %s elmozdulás látszik: a kapcsolatindex %.2f-ről %.2f-re változott (%s)."
TOPIC = "A(z) %s témában jelentkezett az egyik legerősebb szerkezeti elmozdulás; a leginkább érintett országok: %s."
METHOD_VOTES = "A jelentés a szavazási együttállásból, a strukturális hasonlóságból és a tematikus közelségből felépített kapcsolatindexre támaszkodik. A változás nem egyszerű politikai 'barátságot' jelent, hanem azt, hogy két ország mennyire mozog együtt a vizsgált időszakban, és ez az együttmozgás milyen irányban rendeződött át."
METHOD_EVENTS = "A jelentés a közvetlen együttmegjelenésből, a hálózati hasonlóságból és a tematikus profilok közelségéből számolt kapcsolatindexre épül. Ez nem formális szövetségi státuszt mér, hanem a vizsgált időszakban megfigyelhető politikai és narratív együttmozgást."

NOTHING = "nincs adat"
TOP_COUNTRY = "%s mutatta a legerősebb országos elmozdulást: %s irányú változás (%s), aktuális átlagos kapcsolati szint %.2f."
TOP_PAIR = "A legjelentősebb országpármozgás %s és %s között látható: %s kapcsolat, %s trenddel (%s), aktuális index %.2f."
TOP_TOPIC = "A legerősebb tematikus elmozdulás a(z) %s területén jelent meg, %.2f összesített változással."
TOP_GAINER = "A legerősebb közeledés %s és %s között jelent meg, %s változással."
TOP_LOSER = "A legnagyobb eltávolodás %s és %s között látható, %s változással."
WEEK_TOPIC = "A heti mozgások közül a(z) %s téma emelkedett ki %.2f összesített elmozdulással."

FOCUS = "A V4-en belüli együttmozgás: %s."
FOCUS_NOTHING = "A V4-kapcsolatokhoz nem áll rendelkezésre elég adat."
QUICK = "Magyarország rövid távon %s pályán van: az aktuális kapcsolati szint %.2f, ami %s pozíciónak felel meg."
QUICK_FOCUS = " A V4-átlag jelenleg %.2f."
QUICK_OUTSIDE = " Az Ukrajnához kapcsolt külön indikátor értéke %.2f."
QUICK_NOTHING = "Magyarországhoz nem áll rendelkezésre országos összegző adat."
RELATION = "Magyarország aktuális kapcsolati szintje %.2f, az előző összevetési szint %.2f; ez összességében %s pozíciót jelez."
RELATION_NOTHING = "Magyarország kapcsolati helyzetéhez nincs elég adat."
TREND = "Az országos minta alapján a heti irány %s, a változás mértéke %s."
TREND_NOTHING = "Magyarország heti irányához nincs elég adat."
REGION_FOCUS = "A V4-átlag %.2f"
REGION_OUTSIDE = "Ukrajna külön indikátora %.2f"
REGION_NOTHING = "Ukrajnához nincs bekötött külön érték"
OUTSIDE_NOTE, OUTSIDE_NOTHING = "külön adatforrás", "Ukrajnához jelenleg nincs bekötött külön adatforrás."
