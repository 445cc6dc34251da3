"""Fixed values of the file format and its published rules."""

# The variation names of the flame format, alphabetically.
VARIATIONS = (
    "arch auger bent bent2 bipolar blade blob blur boarders bubble butterfly cell conic cos cosh cosine cot coth "
    "cpow cross csc csch curl curve cylinder diamond disc disc2 edisc elliptic escher ex exp exponential eyefish "
    "fan fan2 fisheye flower flux foci gaussian_blur handkerchief heart hemisphere horseshoe hyperbolic julia "
    "julian juliascope lazysusan linear log loonie mobius modulus ngon noise oscilloscope parabola pdj perspective "
    "pie polar polar2 popcorn popcorn2 post_curl power pre_blur radial_blur rays rectangles rings rings2 scry sec "
    "sech secant2 separation sin sinh sinusoidal spherical spiral split splits square stripes super_shape swirl "
    "tan tangent tanh twintrian waves waves2 wedge wedge_julia wedge_sph whorl"
).split()
# Variations whose denominators vanish.
HYPER_TRIG = "tan sec csc cot tanh sech csch coth".split()
# Xform attributes that a manifest never counts as variations.
NOT_VARIATIONS = "weight color color_speed symmetry animate opacity var_color coefs post chaos plotmode name".split()
# Columns of a manifest, in order.
MANIFEST = "id sha256 file_size_bytes fetched_at source_url name nick url xform_count final_xform variations".split()
# Fixed values of the format.
IDENTITY_POST = "1 0 0 1 0 0"
FILE_PREFIX = "electricsheep"
LIVE_GENS = [247, 248]
BUCKET, WINDOW = 10_000, 256
SCHEMA_VERSION, GENS_SCHEMA, BODY_VERSION = 6, 2, 1
