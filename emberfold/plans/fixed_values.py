"""Lookup values for the four hazard feeds.

Every table below is a list of fixed values: the cleaned results depend on
exactly these entries, in this order (where a key is listed twice, the later
entry is the one that counts).
"""

from __future__ import annotations

# Coordinates that replace whatever an earthquake record says.
# (earthquake id, year, "latitude, longitude")
EARTHQUAKE_COORDINATES = [
    (7261, 1118, "51.5, -2.5"),
    (8261, 1842, "46.8, -71.2"),
    (6266, 1916, "10.0, -84.1"),
    (5948, 1489, "40.7, 27.5"),
    (6881, 1719, "13.7, -89.1"),
    (9892, 1681, "-6.9, 107.6"),
    (7264, 1732, "64.0, -20.3"),
    (6882, 1798, "13.8, -89.5"),
    (8179, 857, "31.0, 31.2"),
    (338, 1048, "51.9, -1.3"),
    (7263, 1734, "64.1, -21.0"),
    (6015, 1403, "33.5, 36.3"),
    (7787, 1870, "45.8, 15.9"),
    (10061, 1865, "34.7, 135.5"),
    (6554, 1903, "24.6, 121.5"),
    (6639, 1932, "37.2, -117.0"),
    (6880, 1707, "13.6, -89.2"),
    (7262, 1734, "55.0, -2.0"),
    (6379, 1957, "-9.5, 159.5"),
    (10012, 1848, "-41.3, 174.8"),
    (1624, 1817, "34.6, 109.0"),
    (7790, 1870, "40.8, 14.1"),
    (6306, 1878, "37.7, -122.5"),
    (6067, 1852, "36.6, -121.9"),
    (9952, 1269, "38.0, 38.0"),
    (9912, 1885, "36.9, 5.2"),
    (10214, 1919, "10.5, -67.0"),
    (7775, 1978, "40.8, 15.0"),
    (1268, 1737, "22.5, 88.4"),
    (10009, 1881, "-21.1, -175.2"),
    (3800, 1945, "1.2, 31.6"),
    (1056, 1669, "24.8, 92.0"),
    (6612, 1885, "-5.3, 102.2"),
    (9800, 1651, "-16.5, -73.6"),
    (6879, 1659, "13.7, -89.3"),
    (6076, 1839, "35.0, -90.0"),
    (3567, 1935, "-0.6, 133.0"),
    (9790, 1537, "19.3, -98.9"),
    (10210, 1870, "16.4, -61.7"),
    (6016, 1332, "37.9, 27.3"),
    (10062, 1865, "-16.1, -74.6"),
    (10154, 1866, "38.4, 22.4"),
    (6577, 1912, "6.9, 158.2"),
    (3651, 1939, "-0.5, 100.3"),
    (10060, 1876, "35.7, 139.7"),
    (10058, 551, "34.0, 25.0"),
    (6878, 1576, "13.5, -89.6"),
    (6697, 1500, "36.0, -120.0"),
    (10023, 1877, "40.8, -124.0"),
    (3705, 1942, "-8.1, 114.5"),
    (9914, 1885, "65.0, -20.0"),
    (10053, 1897, "-39.0, 176.0"),
    (7791, 1871, "44.5, 11.0"),
]

# Month and day of earthquakes whose date is incomplete.
# (earthquake id, month, day)
EARTHQUAKE_DATES = [
    (411, 8, 12),
    (513, 7, 20),
    (2771, 5, 15),
    (234, 1, 25),
    (445, 5, 17),
    (999, 11, 13),
    (1374, 4, 10),
    (8099, 5, 15),
    (1806, 1, 1),
    (430, 5, 11),
    (465, 8, 14),
    (8116, 8, 22),
    (402, 9, 30),
    (218, 6, 15),
    (376, 2, 18),
    (405, 4, 23),
    (455, 3, 9),
    (397, 10, 3),
    (485, 8, 1),
    (516, 11, 5),
    (83, 6, 12),
    (637, 12, 10),
    (321, 7, 14),
    (525, 10, 25),
    (4019, 4, 18),
    (416, 8, 29),
    (600, 10, 15),
    (927, 1, 20),
    (1864, 2, 4),
    (2066, 6, 30),
    (419, 6, 29),
    (163, 4, 18),
    (1001, 3, 28),
    (1047, 11, 25),
    (185, 8, 10),
    (187, 4, 19),
    (9952, 9, 1),
    (1108, 1, 11),
    (155, 5, 23),
    (227, 12, 6),
    (552, 2, 14),
    (615, 11, 18),
    (989, 2, 15),
    (199, 8, 20),
    (211, 5, 24),
    (309, 1, 8),
    (546, 3, 15),
    (7964, 6, 19),
    (944, 2, 23),
    (81, 10, 11),
    (9869, 7, 6),
    (116, 9, 14),
    (370, 8, 5),
    (418, 5, 22),
    (1418, 2, 17),
    (1447, 4, 30),
    (365, 6, 10),
    (655, 9, 25),
    (737, 3, 12),
    (2079, 12, 21),
    (344, 10, 23),
    (590, 5, 8),
    (8181, 7, 19),
    (1027, 8, 17),
    (1325, 11, 25),
    (188, 7, 27),
    (761, 11, 16),
    (220, 12, 15),
    (646, 10, 20),
    (1203, 5, 3),
    (8117, 4, 25),
    (74, 9, 10),
    (326, 12, 24),
    (791, 11, 20),
    (408, 10, 26),
    (1014, 3, 15),
    (148, 12, 14),
    (429, 9, 5),
    (566, 8, 20),
    (616, 12, 18),
    (2287, 8, 15),
    (462, 12, 25),
    (1353, 1, 30),
]

# Longitude and latitude of tsunami sources without coordinates.
# (country, location, longitude, latitude)
TSUNAMI_COORDINATES = [
    ("USA", "COOK INLET, AK", -151.0, 60.0),
    ("TAIWAN", "TAIWAN", 121.0, 23.0),
    ("USA", "HAWAII", -157.0, 20.0),
    ("USA", "WASHINGTON-OREGON", -123.0, 46.0),
    ("COOK ISLANDS", "COOK IS.", -159.0, -21.0),
    ("VANUATU", "MALO PASS", 167.0, -15.5),
    ("TOGO", "GOLD COAST", 1.0, 6.0),
    ("MARSHALL ISLANDS, REP. OF", "MARSHALL ISLANDS", 171.0, 7.0),
    ("USA", "LOUISIANA: GRAND ISLE", -90.0, 29.0),
    ("NEW ZEALAND", "LAKE TAUPO, NORTH ISLAND", 175.9, -38.7),
    ("USA", "SAN FRANCISCO, CA", -122.4, 37.8),
    ("MICRONESIA, FED. STATES OF", "YAP ISLANDS, CAROLINE ISLANDS", 138.1, 9.5),
    ("USA", "SANTA BARBARA, S. CALIFORNIA", -119.7, 34.4),
    ("INDONESIA", "INDONESIA", 120.0, -5.0),
    ("PAPUA NEW GUINEA", "HUON GULF, SOLOMON SEA", 147.0, -6.0),
    ("COSTA RICA", "COSTA RICA-PANAMA", -83.0, 9.0),
    ("DOMINICAN REPUBLIC", "SANTO DOMINGO", -69.9, 18.5),
    ("FRENCH POLYNESIA", "MAUPIHAA", -152.0, -16.5),
    ("USA", "GULF OF MEXICO", -90.0, 25.0),
    ("AUSTRALIA", "TASMAN SEA", 150.0, -40.0),
    ("CHILE", "NORTHERN CHILE", -70.0, -20.0),
    ("KOREA", "KOREA", 127.0, 37.0),
    ("USA", "N. CALIFORNIA", -122.0, 40.0),
    ("RUSSIA", "TATAR STRAIT", 141.0, 47.0),
    ("PHILIPPINES", "W. LUZON ISLAND", 120.0, 16.0),
    ("ITALY", "CALABRIAN ARC", 16.0, 38.0),
    ("USA", "CALIFORNIA", -120.0, 36.0),
    ("PHILIPPINES", "SULU SEA", 121.0, 6.0),
    ("USA", "SE. ALASKA, AK", -135.0, 58.0),
    ("GREECE", "AEGEAN SEA", 25.0, 38.0),
    ("VENEZUELA", "CARUPANO", -63.0, 10.6),
    ("USA", "GRAND HAVEN, MICHIGAN", -86.2, 43.0),
    ("MEXICO", "S. MEXICO", -97.0, 16.0),
    ("USA", "WILLETTS POINT, NEW YORK", -73.8, 40.8),
    ("PORTUGAL", "AZORES", -28.0, 38.5),
    ("NEW ZEALAND", "GOOSE BAY, SOUTH ISLAND", 173.0, -42.0),
    ("AUSTRALIA", "BONDI BEACH, SYDNEY", 151.3, -33.9),
    ("USA", "HOLLAND, MICHIGAN", -86.1, 42.8),
    ("USA", "COLUMBIA RIVER VALLEY, WA", -122.0, 46.0),
    ("CHINA", "CHINA: GANSU AND SHANXI PROVINCES", 105.0, 36.0),
    ("PERU", "PERU", -76.0, -10.0),
    ("CHILE", "SOUTHERN CHILE", -73.0, -40.0),
    ("ITALY", "AEGEAN SEA", 25.0, 38.0),
    ("USA", "GULF OF ALASKA, AK", -140.0, 58.0),
    ("USA TERRITORY", "NORTHERN COAST OF PUERTO RICO", -66.5, 18.5),
    ("SOUTH AFRICA", "SOUTH AFRICA", 25.0, -30.0),
    ("INDIA", "INDIA", 78.0, 20.0),
    ("ITALY", "EASTERN ITALY, ADRIATIC SEA", 13.0, 43.0),
    ("JAPAN", "NAGASAKI, JAPAN", 129.9, 32.7),
    ("USA", "S. CALIFORNIA", -118.0, 34.0),
    ("USA", "DAYTONA BEACH, FL", -81.0, 29.2),
    ("AUSTRALIA", "NORFOLK ISLAND", 167.9, -29.0),
    ("USA", "WARREN DUNES, MICHIGAN", -86.6, 41.9),
    ("CANADA", "BRITISH COLUMBIA", -125.0, 50.0),
    ("SOUTH KOREA", "YELLOW SEA", 125.0, 35.0),
    ("SOUTH KOREA", "CHEJU (JEJU) STRAIT", 126.5, 33.5),
    ("USA", "NORTHWEST ATLANTIC OCEAN", -70.0, 40.0),
    ("SPAIN", "MEDITERRANEAN AND BLACK SEAS", 0.0, 38.0),
    ("SCOTLAND", "NORTH SEA", -2.0, 58.0),
    ("NETHERLANDS", "NORTH SEA", 4.0, 54.0),
    ("USA", "NORTHEAST U.S.A.", -73.0, 42.0),
    ("SPAIN", "BALEARIC ISLANDS", 2.5, 39.5),
    ("USA", "LAKE ERIE", -81.0, 42.0),
    ("USA", "GULF OF MEXICO", -90.0, 25.0),
]

# Month and day of eruptions whose date is incomplete.
# (volcano, year, country, month, day)
ERUPTION_DATES = [
    ("Tungurahua", 2010, "Ecuador", 11, 28),
    ("Grimsvotn", 1684, "Iceland", 12, 15),
    ("Sinarka", 1872, "Russia", 11, 10),
    ("Kelut", 1311, "Indonesia", 5, 15),
    ("Tangkubanparahu", 1923, "Indonesia", 6, 20),
    ("Camiguin", 1954, "Philippines", 8, 31),
    ("Rabaul", 1878, "Papua New Guinea", 1, 20),
    ("Oshima", 1957, "Japan", 8, 15),
    ("Merapi", 1932, "Indonesia", 2, 7),
    ("Tengchong", 1609, "China", 5, 1),
    ("Grimsvotn", 1860, "Iceland", 5, 26),
    ("Asuncion", 1819, "United States", 10, 1),
    ("Karthala", 1883, "Comoros", 3, 15),
    ("Kelut", 1586, "Indonesia", 10, 5),
    ("Krakatau", 416, "Indonesia", 8, 1),
    ("Lamongan", 1869, "Indonesia", 8, 10),
    ("Raung", 1817, "Indonesia", 7, 15),
    ("Katla", 934, "Iceland", 10, 1),
    ("Aso", 1872, "Japan", 12, 10),
    ("Pacaya", 1565, "Guatemala", 8, 20),
    ("Katla", 1357, "Iceland", 6, 1),
    ("Changbaishan", 1000, "North Korea", 4, 1),
    ("Dukono", 1550, "Indonesia", 11, 15),
    ("Camiguin", 1949, "Philippines", 6, 30),
    ("Gamalama", 1775, "Indonesia", 9, 1),
    ("Mayon", 1858, "Philippines", 1, 15),
    ("Ceboruco", 930, "Mexico", 2, 1),
    ("Kavachi", 1951, "Solomon Is.", 3, 15),
    ("Raung", 1730, "Indonesia", 6, 1),
    ("Grimsvotn", 1784, "Iceland", 4, 8),
    ("Dieng Volc Complex", 1786, "Indonesia", 6, 20),
    ("Ambrym", 50, "Vanuatu", 7, 1),
    ("Taupo", 230, "New Zealand", 3, 1),
    ("Unnamed", 1907, "Tonga", 7, 15),
    ("Augustine", 350, "United States", 9, 1),
    ("Fuego", 1617, "Guatemala", 10, 1),
    ("Billy Mitchell", 1580, "Papua New Guinea", 5, 1),
    ("Raung", 1593, "Indonesia", 7, 10),
    ("Semeru", 1946, "Indonesia", 2, 6),
    ("Vilyuchik", 1981, "Russia", 8, 1),
    ("Uwayrid, Harrat", 640, "Saudi Arabia", 5, 1),
    ("Calbuco", 1917, "Chile", 4, 11),
    ("Chichon, El", 1375, "Mexico", 3, 1),
    ("Katla", 1177, "Iceland", 9, 1),
    ("Oshima", 1789, "Japan", 7, 1),
    ("Akita-Yake-yama", 1988, "Japan", 5, 1),
    ("Kelut", 1334, "Indonesia", 6, 1),
    ("Sakura-jima", 1946, "Japan", 1, 29),
    ("Ambrym", 1894, "Vanuatu", 10, 15),
    ("Semeru", 1992, "Indonesia", 7, 1),
    ("Pago", 710, "Papua New Guinea", 8, 1),
    ("Lamongan", 1843, "Indonesia", 8, 5),
    ("Rabaul", 683, "Papua New Guinea", 6, 1),
    ("Chokai", 1801, "Japan", 7, 15),
    ("Cotopaxi", 1698, "Ecuador", 8, 1),
    ("Aso", 1854, "Japan", 2, 15),
    ("Makian", 1760, "Indonesia", 7, 25),
    ("Iliwerung", 1870, "Indonesia", 8, 1),
    ("Manam", 1899, "Papua New Guinea", 6, 1),
    ("Manam", 2007, "Papua New Guinea", 3, 27),
    ("Quilotoa", 1280, "Ecuador", 10, 1),
    ("Sirung", 1953, "Indonesia", 6, 15),
    ("Aso", 1957, "Japan", 10, 20),
    ("Tangkubanparahu", 1978, "Indonesia", 3, 1),
    ("Banda Api", 1598, "Pacific Ocean", 5, 1),
    ("Hood", 1934, "United States", 5, 1),
    ("Merapi", 1902, "Indonesia", 12, 15),
    ("Shikotsu", 1804, "Japan", 8, 1),
    ("Ischia", 1302, "Italy", 2, 1),
    ("Katla", 950, "Iceland", 6, 1),
    ("Unzen", 1957, "Japan", 7, 15),
    ("Aso", 1485, "Japan", 1, 20),
    ("Tullu Moje", 1900, "Ethiopia", 4, 1),
    ("Kilauea", 1823, "United States", 2, 15),
    ("Mutnovsky", 1991, "Russia", 6, 15),
    ("Tinakula", 1840, "Solomon Is.", 8, 1),
    ("Aso", 1331, "Japan", 12, 10),
    ("Santorini", 1050, "Greece", 7, 1),
    ("Savo", 1840, "Solomon Is.", 8, 1),
    ("Raung", 1638, "Indonesia", 8, 1),
    ("San Salvador", 590, "El Salvador", 6, 1),
    ("Tungurahua", 2010, "Ecuador", 1, 5),
    ("Katla", 1262, "Iceland", 8, 1),
    ("Peuet Sague", 1837, "Indonesia", 9, 15),
    ("Tungurahua", 1640, "Ecuador", 10, 1),
    ("Paluweh", 1973, "Indonesia", 1, 15),
    ("Etna", 1329, "Italy", 7, 15),
    ("Arhab, Harra of", 500, "Yemen", 6, 1),
    ("Merapi", 1587, "Indonesia", 8, 1),
    ("Aoba", 1914, "Vanuatu", 7, 1),
    ("Merapi", 2000, "Indonesia", 11, 10),
    ("Dakataua", 653, "Papua New Guinea", 7, 1),
    ("Merapi", 1962, "Indonesia", 10, 15),
    ("Grimsvotn", 1861, "Iceland", 5, 15),
    ("Kuwae", 1430, "Vanuatu", 2, 1),
    ("Karthala", 1903, "Comoros", 8, 1),
    ("Krakatau", 1884, "Indonesia", 2, 1),
    ("Rabaul", 1850, "Papua New Guinea", 6, 1),
    ("Tungurahua", 2011, "Ecuador", 4, 11),
    ("Ilopango", 450, "El Salvador", 8, 1),
    ("Sakura-jima", 764, "Japan", 8, 1),
    ("Ksudach", 240, "Russia", 3, 1),
    ("Balbi", 1825, "Papua New Guinea", 7, 1),
    ("Paluweh", 2013, "Indonesia", 2, 5),
    ("Kilauea", 1790, "United States", 11, 1),
    ("Mayon", 1928, "Philippines", 1, 15),
    ("Guntur", 1690, "Indonesia", 6, 1),
    ("Santorini", 1707, "Greece", 5, 15),
    ("Banda Api", 1615, "Pacific Ocean", 3, 15),
    ("Aoba", 1670, "Vanuatu", 8, 1),
    ("Victory", 1890, "Papua New Guinea", 6, 1),
    ("Okataina", 2015, "New Zealand", 10, 15),
    ("Fentale", 1250, "Ethiopia", 8, 1),
    ("Semeru", 1860, "Indonesia", 4, 15),
    ("Hualalai", 1784, "United States", 7, 1),
    ("Iwo-Tori-shima", 1664, "Japan", 8, 1),
    ("Kieyo", 1800, "Tanzania", 6, 1),
    ("Katla", 920, "Iceland", 10, 1),
    ("Kliuchevskoi", 1762, "Russia", 8, 1),
    ("Vesuvius", 1698, "Italy", 5, 15),
    ("Vesuvius", 1813, "Italy", 5, 15),
    ("Kelut", 1998, "Indonesia", 7, 15),
    ("Hualalai", 1800, "United States", 8, 1),
    ("Teon", 1660, "Pacific Ocean", 2, 15),
    ("Bagana", 1883, "Papua New Guinea", 12, 15),
    ("Marapi", 1975, "Indonesia", 1, 15),
    ("Kelut", 1385, "Indonesia", 6, 1),
    ("Stromboli", 1954, "Italy", 2, 15),
    ("St. Helens", 1800, "United States", 8, 1),
    ("Semeru", 1909, "Indonesia", 9, 15),
    ("Sabancaya", 1784, "Peru", 7, 15),
    ("Bona-Churchill", 847, "United States", 6, 1),
    ("Kuchinoerabu-jima", 1841, "Japan", 4, 15),
    ("Aoba", 1870, "Vanuatu", 8, 1),
    ("Kelut", 1376, "Indonesia", 6, 1),
    ("Augustine", 1540, "United States", 8, 1),
    ("Semeru", 2002, "Indonesia", 7, 15),
    ("Asama", 1936, "Japan", 2, 15),
    ("Raikoke", 1778, "Russia", 8, 15),
    ("Katla", 1500, "Iceland", 6, 1),
    ("Mayon", 1875, "Philippines", 8, 1),
    ("Aso", 1826, "Japan", 10, 15),
    ("Dakataua", 1895, "Papua New Guinea", 8, 1),
    ("Colima", 1576, "Mexico", 8, 1),
    ("Krisuvik", 1151, "Iceland", 6, 1),
    ("Savo", 1568, "Solomon Is.", 8, 1),
    ("Santorini", 46, "Greece", 6, 1),
    ("Arhab, Harra of", 200, "Yemen", 6, 1),
    ("Bona-Churchill", 60, "United States", 6, 1),
    ("Lokon-Empung", 1775, "Indonesia", 8, 1),
    ("Tseax River Cone", 1730, "Canada", 6, 1),
    ("Ambalatungan Group", 1952, "Philippines", 8, 1),
    ("Mombacho", 1570, "Nicaragua", 8, 1),
    ("Grimsvotn", 1629, "Iceland", 8, 1),
    ("Cereme", 1698, "Indonesia", 8, 1),
    ("Vesuvius", 787, "Italy", 8, 1),
    ("Ruang", 1870, "Indonesia", 8, 15),
    ("Guntur", 1829, "Indonesia", 8, 1),
    ("Bardarbunga", 1477, "Iceland", 2, 15),
    ("Vesuvius", 1873, "Italy", 8, 1),
    ("Long Island", 1660, "Papua New Guinea", 8, 1),
    ("Raung", 1597, "Indonesia", 8, 1),
]

# Bounding boxes that name the country of a landslide, first match
# wins, edges belong to the box.
# (longitude from, longitude to, latitude from, latitude to, country)
COUNTRY_BOXES = [
    (-45, -43, -23, -20, "Brazil"),
    (-169, -66, 16, 71, "United States"),
    (-135, -65, -42, -6, "Brazil (Other)"),
    (-13, 11, 49, 62, "United Kingdom"),
    (67, 135, 3, 36, "India"),
    (92, 161, -12, 13, "Indonesia"),
    (-100, -87, 14, 20, "Mexico"),
    (169, 179, -44, -34, "New Zealand"),
    (103, 130, 27, 54, "China"),
    (118, 125, 4, 11, "Philippines"),
    (-61, -60, 10, 14, "Trinidad and Tobago"),
    (-85, -75, -5, 5, "Colombia"),
    (-80, -65, -18, 15, "Peru"),
    (110, 155, -11, -1, "Papua New Guinea"),
    (139, 154, 33, 45, "Japan"),
    (6, 30, 35, 47, "Italy"),
    (-82, -77, 17, 23, "Jamaica"),
    (27, 45, -5, 5, "Kenya"),
    (112, 130, -1, 8, "Malaysia"),
    (178, 180, -19, -17, "Fiji"),
    (28, 48, 35, 45, "Turkey"),
    (-75, -65, -56, -17, "Argentina"),
    (16, 32, -35, -20, "South Africa"),
    (141, 154, -39, -10, "Australia"),
    (-141, -52, 41, 83, "Canada"),
    (-90, -85, 13, 17, "Guatemala"),
    (22, 38, 22, 31, "Egypt"),
    (60, 80, 35, 45, "Tajikistan"),
    (2, 14, 4, 14, "Nigeria"),
    (-15, -1, 5, 15, "Sierra Leone"),
    (25, 35, -15, -5, "Malawi"),
    (-5, 5, 35, 45, "Algeria"),
    (20, 40, 46, 52, "Ukraine"),
    (34, 42, 31, 37, "Jordan"),
    (-150, -140, -18, -15, "French Polynesia"),
    (48, 52, 35, 40, "Iran"),
    (65, 67, 24, 25, "Pakistan"),
    (36, 39, 7, 9, "Ethiopia"),
    (-10, -8, 38, 40, "Portugal"),
    (47, 49, -20, -19, "Madagascar"),
    (-39, -38, -13, -12, "Ocean (near Brazil)"),
    (35, 37, -8, -7, "Ocean (near Tanzania)"),
    (-171, -170, -15, -14, "American Samoa"),
    (-79, -78, 7, 8, "Panama"),
    (-69, -68, -17, -16, "Bolivia"),
]

# Labels of coded columns; a code that is not listed stays as text.
TSUNAMI_VALIDITY = {
    0: "event that only caused a seiche",
    1: "very doubtful tsunami",
    2: "questionable tsunami",
    3: "probable tsunami",
    4: "definite tsunami",
}
TSUNAMI_CAUSE = {
    0: "Unknown",
    1: "Earthquake",
    2: "Questionable Earthquake",
    3: "Earthquake and Landslide",
    4: "Volcano and Earthquake",
    5: "Volcano, Earthquake, and Landslide",
    6: "Volcano",
    7: "Volcano and Landslide",
    8: "Landslide",
    9: "Meteorological",
    10: "Explosion",
    11: "Astronomical Tide",
}
DEATHS_SCALE = {
    0: "None",
    1: "Few (~1 to 50 deaths)",
    2: "Some (~51 to 100 deaths)",
    3: "Many (~101 to 1000 deaths)",
    4: "Very many (over 1000 deaths)",
}
INJURIES_SCALE = {
    0: "None",
    1: "Few (~1 to 50 injuries)",
    2: "Some (~51 to 100 injuries)",
    3: "Many (~101 to 1000 injuries)",
    4: "Very many (over 1000 injuries)",
}
EXPLOSIVITY = {
    0: "Non-explosive",
    1: "Gentle",
    2: "Explosive",
    3: "Severe",
    4: "Cataclysmic",
    5: "Paroxysmal",
    6: "Colossal",
    7: "Super-colossal",
    8: "Mega-colossal",
}
