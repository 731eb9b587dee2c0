"""Results the library has to reproduce to the last digit."""

# Mean of each hour of the day, hours 0 to 23.
HOURLY_MEANS = {
    ("IT", "carbon-intensity"): [
        280.35779572055407,
        279.44570181322456,
        278.9601300635785,
        281.5439355942911,
        284.95088317996425,
        280.3798355530746,
        265.65344953700173,
        248.48633826619383,
        235.09379886781247,
        226.01212192773002,
        220.76321695733773,
        219.02932912107204,
        221.68629018481997,
        229.27109520799243,
        243.04915765113492,
        260.6126901834163,
        276.17103350023797,
        285.18136892246923,
        289.71220402126846,
        293.71542077452904,
        296.7462081230315,
        296.30667342982986,
        288.7998154031178,
        282.0455308583891,
    ],
    ("IT", "cfe"): [
        47.46551672291217,
        47.73470221603676,
        47.79587269025172,
        47.01153318299405,
        45.62150585284223,
        46.20783019800206,
        49.35169063048523,
        52.606625608513404,
        54.77684466435761,
        56.26066394181875,
        57.13005469711899,
        57.42364820497318,
        56.845366152241816,
        55.23506504374771,
        52.37815875994025,
        48.91650926797542,
        46.44722791276184,
        45.76407937004826,
        45.028124599730944,
        43.43688571493892,
        42.20317592072536,
        42.428425734700774,
        44.718822763849005,
        46.81546887887985,
    ],
    ("SE", "carbon-intensity"): [
        4.284784397774572,
        4.407043117700906,
        4.561875426406162,
        4.302491443500708,
        3.9121492121988255,
        3.8582956941669564,
        4.349890485926085,
        4.769664609803475,
        5.195557845793384,
        5.489034909670847,
        5.736707735967342,
        5.947180009108549,
        5.9228747418936925,
        5.366119089006643,
        4.7567830255470565,
        4.158959614953139,
        3.908172496004842,
        3.5890622862310626,
        3.357104722805663,
        3.2452429854282365,
        3.166509237153166,
        3.1500615995073873,
        3.438945923762971,
        3.824661195033385,
    ],
    ("SE", "cfe"): [
        99.4119233713013,
        99.39512670309392,
        99.37748808080737,
        99.41158801215222,
        99.46195071074834,
        99.46683780009579,
        99.4110677615981,
        99.35496927792694,
        99.30520873229688,
        99.27351802379444,
        99.2402531534413,
        99.21393558572694,
        99.21544152167789,
        99.27874055062149,
        99.34893904313252,
        99.41028056578796,
        99.44028057226329,
        99.48751550631357,
        99.50905544377613,
        99.52190965760823,
        99.53745386748996,
        99.54097894541945,
        99.50661878957885,
        99.46748802190281,
    ],
}

# Minimum, quartiles and maximum of the hourly means, quartiles interpolated.
EXACT_SUMMARY = {
    ("IT", "carbon-intensity"): (
        219.02932912107204,
        241.0603179553043,
        279.20291593840153,
        285.0085046155905,
        296.7462081230315,
    ),
    ("IT", "cfe"): (
        42.20317592072536,
        45.72843599074675,
        47.60010946947446,
        53.149180372474454,
        57.42364820497318,
    ),
    ("SE", "carbon-intensity"): (
        3.1500615995073873,
        3.765761467832804,
        4.293637920637639,
        4.876137918800953,
        5.947180009108549,
    ),
    ("SE", "cfe"): (
        99.21393558572694,
        99.3380064654236,
        99.41132788687517,
        99.4724948930055,
        99.54097894541945,
    ),
}

# Minimum, quartiles and maximum of the hourly means, quartiles not interpolated.
APPROX_SUMMARY = {
    ("IT", "carbon-intensity"): (
        219.02932912107204,
        235.09379886781247,
        278.9601300635785,
        284.95088317996425,
        296.7462081230315,
    ),
    ("IT", "cfe"): (
        42.20317592072536,
        45.62150585284223,
        47.46551672291217,
        52.606625608513404,
        57.42364820497318,
    ),
    ("SE", "carbon-intensity"): (
        3.1500615995073873,
        3.5890622862310626,
        4.284784397774572,
        4.769664609803475,
        5.947180009108549,
    ),
    ("SE", "cfe"): (
        99.21393558572694,
        99.30520873229688,
        99.4110677615981,
        99.46748802190281,
        99.54097894541945,
    ),
}

# Monthly mean carbon intensity of one country, January 2021 to December 2024.
MONTHLY_CARBON = [
    291.1847178961641,
    270.8513247399103,
    268.7851217536516,
    281.8979860517714,
    217.94821263385074,
    245.7790560828315,
    255.25758050077704,
    248.66248641475553,
    308.954125128852,
    296.7977959417528,
    346.7285132302178,
    329.303508122762,
    326.94787593554423,
    330.4898960022699,
    347.3590725519324,
    286.8294442176819,
    278.9057925029467,
    302.6110416836209,
    320.50360214069326,
    320.9273383027764,
    328.9405973222521,
    335.78474413964057,
    318.86701384650337,
    360.5199997604534,
    325.06354879563855,
    326.3639579727536,
    300.2727551819176,
    219.66870835622152,
    203.49448908528973,
    238.3699028544956,
    248.73204297916863,
    230.27612922012165,
    250.62322221332127,
    234.66126346588135,
    210.0260970433553,
    238.6377016088014,
    232.03063169089697,
    225.6673997791334,
    192.85387103788315,
    170.67088894314236,
    158.24088668310515,
    171.9787917084164,
    200.59599496984995,
    224.4205375896987,
    218.13936148749457,
    206.33559158284177,
    249.97084723578558,
    237.2757798881941,
]

# Monthly mean carbon-free share of one country, January 2021 to December 2024.
MONTHLY_CFE = [
    43.53934137795561,
    48.66818449610756,
    47.38584678403793,
    45.05993056562212,
    58.26255379440964,
    53.06840288374159,
    50.29895158480572,
    52.67657257920952,
    41.64045834276411,
    43.954744679953464,
    33.07668060196771,
    37.86881719866106,
    36.603682807696764,
    38.9805952452478,
    35.82221772337473,
    46.88268055121104,
    49.765564498081005,
    44.93372222847409,
    42.20919355269401,
    40.83943547228331,
    41.09051389959124,
    39.16716400013175,
    42.9276389280955,
    35.83831991687898,
    43.146290281767484,
    41.7236160777864,
    46.18759403946579,
    54.27588880856832,
    59.877002639155236,
    55.66037503348456,
    50.74696233452007,
    54.5571102890917,
    50.49398616419898,
    52.507970371553974,
    58.736986173523796,
    50.69586023463998,
    52.22419353197979,
    54.523318926493324,
    60.919556299845375,
    66.25395845307244,
    68.98973102467035,
    65.48779166009692,
    57.93909945026521,
    52.279959658140776,
    54.22279164261288,
    58.53038978063932,
    48.306319403648374,
    49.46375008295941,
]

# The five (year, month) of each ranking, in order.
RANKED_MONTHS = {
    "carbon_intensity_desc": [(2022, 12), (2022, 3), (2021, 11), (2022, 10), (2022, 2)],
    "carbon_intensity_asc": [(2024, 5), (2024, 4), (2024, 6), (2024, 3), (2024, 7)],
    "cfe_percentage_desc": [(2024, 5), (2024, 4), (2024, 6), (2024, 3), (2023, 5)],
    "cfe_percentage_asc": [(2021, 11), (2022, 3), (2022, 12), (2022, 1), (2021, 12)],
}
