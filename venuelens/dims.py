"""Dictionaries and bucket tables as small dimension DataFrames.

Two families live here:

* the reference dictionaries (fixed values, Chinese terms), used by default when
  cleaning real crawl data;
* stand-in dictionaries over the vocabulary of the driver tables, so that every
  registered query exercises the same code on data Spark reads.

Every dictionary becomes a ``(group, term, priority)`` table (or ``(polarity,
aspect, term, priority)``); priority is the position in the dictionary, so
"first entry wins" rules become ``min_by(group, priority)``.  These tables have
a size fixed by the code, which is what makes broadcasting them safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------
# These must equal the reference's for equal results.
# ---------------------------------------------------------------------------------

# District -> business areas.
BUSINESS_AREA_DICT = {
    "黄浦区": ["南京路", "人民广场", "外滩", "豫园", "新天地", "淮海路"],
    "静安区": ["静安寺", "南京西路", "中山公园", "大宁"],
    "徐汇区": ["徐家汇", "衡山路", "田子坊", "上海南站"],
    "长宁区": ["虹桥", "古北", "中山公园"],
    "普陀区": ["长寿路", "长风公园", "真如"],
    "虹口区": ["四川北路", "虹口足球场", "鲁迅公园"],
    "杨浦区": ["五角场", "大学路", "新江湾城"],
    "浦东新区": ["陆家嘴", "世纪公园", "张江", "金桥", "碧云", "花木", "三林"],
    "闵行区": ["莘庄", "七宝", "虹桥", "古美"],
    "宝山区": ["大场", "共康", "顾村"],
    "嘉定区": ["嘉定新城", "南翔", "安亭"],
    "松江区": ["松江大学城", "泗泾", "九亭"],
    "青浦区": ["青浦新城", "徐泾", "朱家角"],
    "奉贤区": ["南桥", "奉贤新城"],
    "金山区": ["金山新城", "枫泾"],
    "崇明区": ["崇明新城", "陈家镇"],
}

# The sixteen known districts, in the order the dashboard lists them.
KNOWN_DISTRICTS = ["浦东新区", "黄浦区", "徐汇区", "静安区", "长宁区", "普陀区", "虹口区", "杨浦区",
                   "闵行区", "宝山区", "嘉定区", "松江区", "青浦区", "奉贤区", "金山区", "崇明区"]

# Category -> synonyms (first group listing a term wins).
CUISINE_DICT = {
    "本帮菜": ["本帮", "上海菜", "本地菜", "浓油赤酱"],
    "川菜": ["川菜", "四川菜", "麻辣", "火锅", "串串"],
    "粤菜": ["粤菜", "广东菜", "早茶", "煲仔饭", "烧腊"],
    "湘菜": ["湘菜", "湖南菜", "剁椒", "臭豆腐"],
    "鲁菜": ["鲁菜", "山东菜", "海鲜"],
    "苏菜": ["苏菜", "江苏菜", "淮扬菜", "南京菜"],
    "浙菜": ["浙菜", "杭帮菜", "宁波菜"],
    "徽菜": ["徽菜", "安徽菜"],
    "日料": ["日本料理", "日料", "寿司", "刺身", "拉面", "居酒屋"],
    "韩料": ["韩国料理", "韩料", "烤肉", "石锅拌饭", "部队锅"],
    "西餐": ["西餐", "牛排", "意大利菜", "法餐", "披萨", "汉堡"],
    "东南亚菜": ["泰国菜", "越南菜", "新加坡菜", "马来菜", "冬阴功"],
    "烧烤": ["烧烤", "烤串", "烤肉", "BBQ"],
    "火锅": ["火锅", "麻辣烫", "串串香", "冒菜"],
    "小吃快餐": ["小吃", "快餐", "简餐", "盖浇饭", "面馆"],
    "咖啡厅": ["咖啡", "咖啡厅", "咖啡馆", "精品咖啡"],
    "甜品": ["甜品", "蛋糕", "烘焙", "奶茶", "冰淇淋"],
    "酒吧": ["酒吧", "清吧", "livehouse", "夜店"],
}

# Category -> popular dishes.
POPULAR_DISHES_DICT = {
    "本帮菜": ["红烧肉", "糖醋小排", "响油鳝丝", "八宝鸭", "腌笃鲜", "油爆虾"],
    "川菜": ["水煮鱼", "麻婆豆腐", "回锅肉", "宫保鸡丁", "毛血旺"],
    "粤菜": ["白切鸡", "烧鹅", "虾饺", "肠粉", "煲仔饭"],
    "日料": ["三文鱼", "金枪鱼", "寿司", "刺身", "天妇罗", "鳗鱼饭"],
    "火锅": ["毛肚", "鸭肠", "肥牛", "虾滑", "午餐肉"],
    "烧烤": ["羊肉串", "鸡翅", "烤鱼", "烤生蚝", "烤茄子"],
}

# Dining scene -> terms.
SCENE_DICT = {
    "约会": ["约会", "情侣", "浪漫", "二人世界"],
    "聚餐": ["聚餐", "聚会", "朋友聚会", "同学聚会"],
    "商务": ["商务", "商务宴请", "接待", "谈业务"],
    "家庭": ["家庭聚餐", "家人", "亲子", "带娃"],
    "独自": ["一人食", "独自", "单人"],
    "团建": ["团建", "公司聚餐", "年会"],
    "生日": ["生日", "庆生", "寿宴"],
    "下午茶": ["下午茶", "闺蜜", "聊天"],
}

# Service tag -> terms.
SERVICE_DICT = {
    "停车": ["停车", "停车场", "免费停车", "代客泊车"],
    "包厢": ["包厢", "包间", "单间"],
    "外卖": ["外卖", "外送", "配送"],
    "wifi": ["wifi", "无线网络", "免费wifi"],
    "刷卡": ["刷卡", "信用卡", "银联"],
    "预订": ["可预订", "接受预订", "需预约"],
    "宠物": ["宠物友好", "可带宠物"],
    "儿童": ["儿童座椅", "儿童餐", "亲子"],
    "无障碍": ["无障碍", "轮椅通道"],
}

# Polarity -> aspect -> terms.
SENTIMENT_DICT = {
    "正面": {
        "味道": ["好吃", "美味", "鲜美", "入味", "香", "地道", "正宗"],
        "环境": ["环境好", "装修好", "干净", "舒适", "氛围好", "有格调"],
        "服务": ["服务好", "热情", "周到", "贴心", "专业"],
        "性价比": ["实惠", "划算", "性价比高", "便宜", "值得"],
    },
    "负面": {
        "味道": ["难吃", "不好吃", "不新鲜", "变质", "太咸", "太淡", "太油"],
        "环境": ["环境差", "脏", "乱", "吵", "拥挤"],
        "服务": ["服务差", "态度差", "冷漠", "慢", "不专业"],
        "性价比": ["贵", "不值", "性价比低", "坑"],
    },
}
POSITIVE, NEGATIVE = "正面", "负面"

# Keyword stop words.
STOP_WORDS = ["真的", "就是", "这个", "那个", "还是", "我们", "你们", "他们", "感觉", "非常", "比较",
              "一个", "一点", "一下", "然后", "而且", "因为", "所以", "但是", "没有", "不是", "可以",
              "不会", "已经", "餐厅", "店里", "这家", "服务员"]

# Keyword token rule (two or more CJK ideographs).
CJK_WORD_PATTERN = "[\\x{4e00}-\\x{9fff}]{2,}"

# Price buckets (label, lower exclusive, upper inclusive; None = open).
PRICE_BUCKETS = [("50元以下", 0, 50), ("51-100元", 50, 100), ("101-200元", 100, 200), ("200元以上", 200, None)]

# Rating buckets (label, lower inclusive, upper exclusive; last closed).
RATING_BUCKETS = [("3.0分以下", 0.0, 3.0), ("3.0-3.9分", 3.0, 4.0), ("4.0-4.4分", 4.0, 4.5), ("4.5-5.0分", 4.5, 5.0)]

# Import column aliases (file header -> canonical column).
COLUMN_ALIASES = {
    "restaurant_id": "restaurant_id", "id": "restaurant_id",
    "name": "restaurant_name", "restaurant_name": "restaurant_name", "餐厅名": "restaurant_name",
    "餐厅名称": "restaurant_name", "title": "restaurant_name",
    "address": "address", "地址": "address",
    "phone": "phone", "电话": "phone", "tel": "phone",
    "business_hours": "business_hours", "营业时间": "business_hours",
    "avg_price": "avg_price", "price": "avg_price", "人均": "avg_price", "人均消费": "avg_price",
    "rating_overall": "rating_overall", "rating": "rating_overall", "评分": "rating_overall",
    "review_count": "review_count", "reviews": "review_count", "评论数": "review_count",
    "cuisine_type": "cuisine_type", "cuisine": "cuisine_type", "菜系": "cuisine_type",
    "district": "district", "区域": "district", "行政区": "district",
    "business_area": "business_area", "商圈": "business_area",
    "latitude": "latitude", "lat": "latitude", "纬度": "latitude",
    "longitude": "longitude", "lng": "longitude", "经度": "longitude",
}

# Landing-table tag -> merged category (anything else -> NULL).
CATEGORY_MERGE = {
    "本帮菜": ["本帮菜", "特色菜", "私房菜", "创意菜", "美食", "地方菜系"],
    "粤菜/港式": ["粤菜馆", "粤菜", "广州菜", "粤式茶点", "茶餐厅", "潮汕菜", "打边炉/港式火锅"],
    "川湘菜": ["湘菜", "川菜馆", "川菜"],
    "江浙菜": ["浙菜", "苏浙菜", "淮扬菜", "苏帮菜", "江浙菜", "徽菜"],
    "北方菜": ["鲁菜", "东北菜", "江西菜"],
    "火锅": ["重庆火锅", "四川火锅", "潮汕牛肉火锅", "火锅", "海鲜火锅", "小火锅", "云南火锅",
           "老北京火锅", "日式火锅", "鱼火锅"],
    "烧烤/烤肉": ["烤串", "日式烧烤/烤肉", "融合烤肉", "烧烤烤串", "烤羊腿", "烤鱼"],
    "日本料理": ["日本料理", "寿司", "日式铁板烧"],
    "韩国料理": ["韩式料理", "韩式烤肉", "韩式小吃"],
    "东南亚菜": ["泰国菜", "越南菜", "东南亚菜", "新加坡菜", "南洋中菜"],
    "西餐": ["西餐", "意大利菜", "法国菜", "牛排", "西班牙菜", "印度菜"],
    "海鲜": ["海鲜", "小龙虾"],
    "自助餐": ["自助餐", "海鲜自助", "烤肉自助", "烤涮一体自助", "寿喜锅/烧自助"],
    "面食/小吃": ["面馆", "小吃快餐", "快餐简餐", "小笼", "包子", "生煎"],
    "甜品/饮品": ["甜品", "茶饮果汁", "面包蛋糕", "面包蛋糕甜品", "咖啡", "饮品", "冰淇淋"],
    "素食": ["素食", "素食自助"],
}

# Landing business area (exact) -> district, checked in this order.
AREA_RULES_EXACT = {
    "杨浦区": ["五角场/大学路", "新江湾城商圈", "中原地区", "平凉路/东外滩", "控江地区", "黄兴公园", "杨浦区"],
    "浦东新区": ["陆家嘴商圈", "洋泾商圈", "世纪大道", "金桥商圈", "八佰伴", "张江商圈", "世博园", "康桥/周浦",
             "御桥", "滴水湖临港地区", "曹路商圈", "前滩", "迪士尼", "川沙", "高行商圈", "上南地区", "塘桥商圈",
             "金杨地区", "唐镇商圈", "外高桥", "惠南镇商圈", "源深体育中心", "世博源", "蒙山路", "世纪公园/科技馆",
             "联洋", "花木商圈", "北蔡商圈", "南汇新城", "三林地区", "新场商圈", "碧云社区", "航头商圈",
             "浦东机场/机场镇", "浦东新区", "泥城", "江镇", "卫清路", "绿地风尚/万达广场", "飞航广场", "环城东路"],
    "黄浦区": ["人民广场/南京路", "南京东路商圈", "外滩商圈", "老西门/陆家浜路", "新天地/马当路", "打浦桥/田子坊",
            "日月光中心广场", "西藏南路/世博会馆", "光启城", "城隍庙/豫园", "黄浦区"],
    "静安区": ["南京西路商圈", "静安寺商圈", "闸北公园", "大宁地区", "苏河湾", "同乐坊/江宁路", "曹家渡商圈",
            "彭浦新村商圈", "彭浦镇商圈", "市北工业园/汶水路"],
    "徐汇区": ["徐家汇商圈", "漕河泾/田林", "万体馆", "龙华/西岸", "衡山路/复兴西路", "肇嘉浜路/中山医院",
            "音乐学院/五官科医院", "上海南站"],
    "长宁区": ["中山公园/江苏路", "北新泾/淞虹路", "龙柏地区", "虹桥/古北", "天山", "古北/仙霞新村",
            "上海影城/新华路", "长宁区", "复兴西路/丁香花园"],
    "普陀区": ["真如商圈", "月星环球港", "真北中环", "长风公园/华师大", "长寿路商圈", "武宁地区", "曹杨地区", "丰庄",
            "中山北路/甘泉地区", "普陀区"],
    "虹口区": ["临平路/和平公园", "大柏树", "虹口龙之梦", "北外滩/外白渡桥", "海宁路/七浦路", "四川北路/海伦路",
            "曲阳地区", "凉城/江湾镇", "虹口足球场/鲁迅公园", "大连路地铁站", "赤峰路"],
    "闵行区": ["莲花路/南方商城", "七宝商圈", "虹桥枢纽", "虹桥镇商圈", "莘庄商圈", "华漕商圈", "浦江镇商圈", "春申地区",
            "老闵行/交大师大", "虹桥火车站/国展中心", "虹桥火车站/机场", "万源城/东兰路", "虹梅路商圈", "闵浦",
            "颛桥/北桥", "交大闵行校区", "合川路", "闵行开发区"],
    "嘉定区": ["江桥万达广场", "南翔商圈", "嘉定新城", "江桥", "嘉定镇", "外冈镇商圈", "安亭黄渡镇", "马陆镇商圈",
            "安亭镇商圈", "安亭新源路", "嘉定区"],
    "宝山区": ["宝山万达广场", "宝山区", "宝山城区/吴淞", "庙行/共康", "大华地区", "高境商圈", "上海大学", "美兰湖"],
    "松江区": ["松江万达广场", "泗泾镇商圈", "九亭商圈", "松江镇", "松江大学城", "新桥商圈", "松江区"],
    "奉贤区": ["金汇镇商圈", "南桥商圈", "南桥百联购物中心", "奉城镇商圈", "海湾旅游区商圈", "西渡街道商圈", "青村",
            "唐湾镇/曹行镇", "奉贤区"],
    "金山区": ["金山万达", "金山区", "枫泾镇商圈", "金山卫商圈", "石化商圈", "朱泾镇商圈", "廊下商圈", "百联金山购物中心"],
    "青浦区": ["青浦区", "青浦城区", "国家会展中心", "华新镇商圈", "赵巷镇商圈", "凤溪", "重固镇商圈", "徐泾商圈"],
    "崇明区": ["长兴岛", "陈家镇商圈", "崇明区", "堡镇商圈"],
}
# Second-chance exact business areas, then address keywords, then the default.
AREA_RULES_EXACT_LATE = {"黄浦区": ["淮海路"], "浦东新区": ["易买得", "万达广场"]}
AREA_RULES_ADDRESS = [("杨浦", "杨浦区"), ("浦东", "浦东新区"), ("黄浦", "黄浦区"), ("静安", "静安区"),
                      ("徐汇", "徐汇区"), ("长宁", "长宁区"), ("普陀", "普陀区"), ("虹口", "虹口区"),
                      ("闵行", "闵行区"), ("嘉定", "嘉定区"), ("宝山", "宝山区"), ("松江", "松江区"),
                      ("奉贤", "奉贤区"), ("金山", "金山区"), ("青浦", "青浦区"), ("崇明", "崇明区")]
AREA_RULES_DEFAULT = "浦东新区"
# Landing tag excluded from the migration.
EXCLUDED_TAGS = ["洗浴中心"]
# Landing key prefix and source name of the migration.
MIGRATION_PREFIX, MIGRATION_SOURCE = "dp_", "dianping"


def district_aliases() -> dict:
    """Exact district synonyms by rule: every full name and the name without its suffix."""
    out = {}
    for d in KNOWN_DISTRICTS:
        out[d] = d
        short = d[:-2] if d.endswith("新区") else d[:-1]
        out[short] = d
    return out


# ---------------------------------------------------------------------------------
# Stand-in dictionaries over the driver tables' vocabulary (our choice).
# ---------------------------------------------------------------------------------

# Areas of the listing stand-in are brands; these twelve are the "known" list, and
# one of them does not occur, so the empty-area path is exercised.
STANDIN_KNOWN_AREAS = [f"Brand#{i}" for i in range(1, 12)] + ["Brand#99"]

# District -> address terms for contains-matching on raw_listing addresses; the
# short terms overlap longer ones ("Brand#1" is inside "Brand#12"), priority decides.
STANDIN_AREA_DICT = {
    "north": ["Brand#1", "Brand#2", "Brand#3"],
    "east": ["Brand#12", "Brand#4", "Brand#5"],
    "south": ["Brand#6", "Brand#7", "Brand#13", "Brand#2"],
    "west": ["Brand#8", "Brand#9", "Brand#24"],
}

# Category -> synonyms for case-insensitive contains matching on raw cuisines;
# "medium" sits in two groups and the first wins.
STANDIN_CATEGORY_DICT = {
    "budget": ["ECONOMY", "promo"],
    "regular": ["standard", "medium"],
    "compact": ["small", "medium"],
    "big": ["large"],
}

# Exact label -> merged category for the listing category; PROMO is left unmapped.
STANDIN_CATEGORY_MERGE = {
    "value": ["ECONOMY", "SMALL"],
    "core": ["STANDARD", "MEDIUM"],
    "premium": ["LARGE"],
}

# Exact business area -> district rules, address keywords, default.
STANDIN_AREA_RULES_EXACT = {"north": ["Brand#1/0", "Brand#1/1", "Brand#2/0"], "east": ["Brand#3/2", "Brand#4/3"]}
STANDIN_AREA_RULES_ADDRESS = [("Brand#5", "south"), ("Brand#6", "west"), ("Brand#1", "north")]
STANDIN_AREA_RULES_DEFAULT = "central"

# Polarity -> aspect -> terms over document words.
STANDIN_SENTIMENT_DICT = {
    "positive": {"taste": ["thing", "thin", "bien"], "setting": ["avec", "with", "dans"],
                 "service": ["est", "qui", "für"], "value": ["pour", "par"]},
    "negative": {"taste": ["nicht", "no"], "setting": ["pas", "sur"],
                 "service": ["kein", "ohne"], "value": ["dem", "im"]},
}
STANDIN_STOP_WORDS = ["the", "of", "de", "and", "to", "in", "la", "der", "is", "en"]
# Words of two or more letters of any alphabet (lower-cased before matching).
LATIN_WORD_PATTERN = r"\p{L}{2,}"

# Dish lexicon over document words; "thin"/"thing" and "the"/"then" overlap.
STANDIN_DISHES_DICT = {
    "soups": ["thing", "thin", "then"],
    "grill": ["tion", "thre", "thea"],
    "sweets": ["erin", "eren", "sch"],
}
STANDIN_SCENE_DICT = {
    "date": ["avec", "dans"],
    "group": ["und", "with"],
    "business": ["für", "von"],
    "family": ["que", "los"],
}


# ---------------------------------------------------------------------------------
# Dictionary -> DataFrame
# ---------------------------------------------------------------------------------

def terms_df(spark: SparkSession, mapping: dict) -> DataFrame:
    """``{group: [term, ...]}`` -> ``(grp, term, priority)``; priority = dictionary position."""
    rows, pos = [], 0
    for g, terms in mapping.items():
        for t in terms:
            rows.append((g, t, pos))
            pos += 1
    schema = T.StructType([T.StructField("grp", T.StringType(), False),
                           T.StructField("term", T.StringType(), False),
                           T.StructField("priority", T.IntegerType(), False)])
    return spark.createDataFrame(rows, schema)


def polarity_terms_df(spark: SparkSession, mapping: dict) -> DataFrame:
    """``{polarity: {aspect: [terms]}}`` -> ``(polarity, aspect, term, priority)``."""
    rows, pos = [], 0
    for pol, aspects in mapping.items():
        for asp, terms in aspects.items():
            for t in terms:
                rows.append((pol, asp, t, pos))
                pos += 1
    schema = T.StructType([T.StructField("polarity", T.StringType(), False),
                           T.StructField("aspect", T.StringType(), False),
                           T.StructField("term", T.StringType(), False),
                           T.StructField("priority", T.IntegerType(), False)])
    return spark.createDataFrame(rows, schema)


def words_df(spark: SparkSession, words, col: str = "word") -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], T.StructType([T.StructField(col, T.StringType(), False)]))


def flatten_polarity(mapping: dict) -> dict:
    """``{polarity: {aspect: [terms]}}`` -> ``{polarity: [terms]}`` (the keyword lexicon)."""
    return {pol: [t for terms in aspects.values() for t in terms] for pol, aspects in mapping.items()}
