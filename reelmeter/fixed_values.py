"""Word lists, prompts, questions and weights that results depend on."""

# Fixed values. Subject buckets in priority order; a label belongs to the first
# bucket one of whose words occurs anywhere in it.
SUBJECT_BUCKETS = (
    ("humans", ("person", "man", "woman", "boy", "girl")),
    (
        "animals",
        (
            "cat", "dog", "bird", "horse", "sheep", "cow", "elephant", "bear",
            "zebra", "giraffe", "duck", "animal", "monkey", "panda", "tiger", "lion",
        ),
    ),
    (
        "vehicles",
        (
            "car", "truck", "bus", "train", "motorcycle", "bicycle", "plane",
            "boat", "ship", "van",
        ),
    ),
    (
        "food",
        (
            "banana", "apple", "sandwich", "orange", "broccoli", "carrot", "pizza",
            "cake", "hot dog", "donut",
        ),
    ),
)
OTHER_BUCKET = "others"

# Fixed values. Prompts asked of every frame, in answer order.
SHOT_PROMPTS = ("<COLOR>", "<LIGHTING>", "<LIGHTING_TYPE>", "<COMPOSITION>")

# Fixed values. Padding marker of generated answers, marker of prompt-dependent questions.
PAD = "<pad>"
PROMPT_MARK = "[[prompt]]"

# Fixed values. Questions asked of every clip, in weight order.
QUESTIONS = (
    'Does the video meet all the requirements stated in the text "[[prompt]]"?',
    'Does the video meet most of the requirements stated in the text "[[prompt]]"?',
    'Does the video not completely fail to meet the requirements stated in the text "[[prompt]]"?',
    "Is the composition aesthetically pleasing?",
    "Does the composition have no obvious flaws?",
    "Does the camera movement have no obvious flaws?",
    "Are the colors not significantly unattractive?",
    "Is the lighting perfectly accurate?",
    "Does the lighting have no obvious errors?",
    "Is there any lighting present?",
    "Is the lighting exceptionally beautiful?",
    "Is the lighting beautiful?",
    "Is the lighting not unattractive?",
    "Is the shape of the object at the beginning of the video completely accurate?",
    "Does the shape of the object at the beginning have no obvious errors?",
    "Is the shape of the object at the beginning not chaotic?",
    "Is the shape of the object perfectly maintained throughout the video?",
    "Is the shape of the object not chaotic throughout the video?",
    "Is the camera motion highly dynamic?",
    "Is the camera motion not minimal?",
    "Is the smoothness of the object's movement very good?",
    "Is the object's movement completely realistic?",
    "Is the image quality very stable?",
    "Are the details very refined?",
    "Are the details not rough?",
    "Are the details not significantly rough?",
    "Are all the letters correct?",
    "Are there any letters present?",
    "Is the video content part of the physical world?",
)

# Fixed values. Weight of each question above.
QUESTION_WEIGHTS = (
    0.9543901856422174,
    0.25239747290239256,
    1.141818673357406,
    0.03495652038170829,
    0.025237463294006605,
    0.12600844108184325,
    0.03221505988621183,
    0.16286819641189937,
    0.21673935360893115,
    0.01970324496671629,
    0.13604019362894557,
    0.09647134683834487,
    0.15490927135496332,
    0.1294164598219855,
    0.09891696198970226,
    0.18839328668539077,
    0.1844335421380767,
    0.2635526157239052,
    0.11168980468489233,
    0.05173789659242723,
    0.02562797122879315,
    0.4389890596048526,
    0.26857694964769424,
    0.42925171836383774,
    0.00846154228462919,
    0.12757277121689847,
    0.05798205026065391,
    0.1446334304609205,
    0.39418111694677266,
)

# Fixed values. Channel means and deviations (R, G, B) of the image scaling step.
CHANNEL_MEANS = (0.485, 0.456, 0.406)
CHANNEL_DEVIATIONS = (0.229, 0.224, 0.225)

# Fixed values. Black-bar rules.
DARKNESS = 50
BLACK_RATIO = 0.7
BRIGHT_RATIO = 0.8
SCAN_START, SCAN_END, SCAN_STEP = 1.0, 30.0, 0.5
DEFAULT_TOP, DEFAULT_BOTTOM = 0.10, 0.15

# Fixed values. Image file suffixes of a frame directory.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "webp")
