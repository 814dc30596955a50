"""Entity and relation types, rules, vocabularies. Operators take them as parameters; these are the defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Names of types.
ENTITY_TYPES = ["Service", "Component", "Pattern", "Pillar", "BestPractice", "Risk", "Mitigation", "Metric", "Role"]
PLAIN_ENTITY_TYPES = ["Concept", "Document", "Section", "Domain", "Category"]
RELATIONS = ["uses", "implements", "addresses", "recommended_by", "affects", "depends_on", "violates", "example_of"]
PLAIN_RELATIONS = ["CONTAINS", "DOCUMENTS", "RELATES_TO", "REFERENCES", "MENTIONS", "EXTRACTS"]

# Which subjects and objects a relation allows.
RULES = {
    "uses": (["Service", "Component"], ["Component", "Service"]),
    "implements": (["Component", "Service"], ["Pattern"]),
    "addresses": (["Mitigation", "BestPractice"], ["Risk"]),
    "recommended_by": (["BestPractice"], ["Pillar"]),
    "affects": (["Service", "Component", "Pattern", "BestPractice"], ["Metric"]),
    "depends_on": (["Service", "Component"], ["Service", "Component"]),
    "violates": (["Service", "Component", "Pattern"], ["Pillar"]),
    "example_of": (["Service", "Component", "Pattern"], ["Pattern"]),
}

# Paraphrases of relations.
PARAPHRASES = {
    "uses": ["utilizes", "employs", "leverages", "makes use of", "uses"],
    "implements": ["implements", "follows", "adopts", "applies"],
    "addresses": ["addresses", "mitigates", "resolves", "solves", "handles"],
    "recommended_by": ["recommended_by", "recommended", "suggested_by", "suggested", "aligned_with"],
    "affects": ["affects", "impacts", "influences", "improves", "enhances", "reduces"],
    "depends_on": ["depends_on", "depends", "requires", "relies_on", "needs"],
    "violates": ["violates", "breaks", "contradicts", "conflicts_with"],
    "example_of": ["example_of", "example", "instance_of", "demonstrates"],
}

# Services and the names that they go by in running text.
SERVICE_TERMS = {
    "Amazon EC2": ["EC2", "Elastic Compute Cloud", "EC2 instance"],
    "Amazon S3": ["S3", "Simple Storage Service", "S3 bucket"],
    "Amazon DynamoDB": ["DynamoDB"],
    "Amazon RDS": ["RDS", "Relational Database Service"],
    "AWS Lambda": ["Lambda", "Lambda function"],
    "Amazon VPC": ["VPC", "Virtual Private Cloud"],
    "AWS Transit Gateway": ["TGW", "Transit Gateway"],
    "AWS Direct Connect": ["DX", "DirectConnect"],
    "AWS Site-to-Site VPN": ["VPN", "IPSec VPN", "Site-to-Site"],
    "AWS Client VPN": ["Client VPN"],
    "AWS IAM": ["IAM", "Identity and Access Management"],
    "AWS CloudWatch": ["CloudWatch"],
    "AWS CloudTrail": ["CloudTrail"],
    "Amazon Route 53": ["Route53", "Route 53", "R53"],
    "Elastic Load Balancing": ["ELB", "ALB", "NLB", "CLB"],
    "AWS PrivateLink": ["PrivateLink", "VPC Endpoint"],
    "Amazon CloudFront": ["CloudFront", "CDN"],
    "AWS EKS": ["EKS", "Elastic Kubernetes Service"],
    "Amazon SNS": ["SNS"],
    "Amazon SQS": ["SQS"],
    "Amazon Kinesis": ["Kinesis"],
}

# Technology keywords and the names shown for them.
TECHNOLOGY_TERMS = {
    "ENI": "Elastic Network Interface",
    "CIDR": "CIDR Block",
    "NAT Gateway": "NAT Gateway",
    "Internet Gateway": "Internet Gateway",
    "IGW": "Internet Gateway",
    "NATGW": "NAT Gateway",
    "Subnets": "Subnet",
    "Availability Zone": "AZ",
    "AZ": "Availability Zone",
    "VPC Peering": "VPC Peering",
    "BGP": "Border Gateway Protocol",
    "IPSec": "IPSec",
    "TCP": "TCP",
    "UDP": "UDP",
    "DNS": "DNS",
    "Egress-only Internet Gateway": "Egress-only IGW",
}

# Architecture terms, sought without word boundaries.
ARCHITECTURE_TERMS = [
    "Route Table", "Security Group", "Network ACL", "Subnet", "Public Subnet", "Private Subnet", "Elastic IP", "VPC Endpoint",
    "Gateway Endpoint", "Interface Endpoint", "Peering Connection", "Transit Gateway Attachment", "VPN Tunnel",
]

# Verbs between two concepts.
CONCEPT_VERBS = {
    "connects to": "CONNECTS_TO",
    "attaches to": "ATTACHES_TO",
    "uses": "USES",
    "is used for": "USED_FOR",
    "peers with": "PEERS_WITH",
    "routes traffic to": "ROUTES_TO",
    "communicates with": "COMMUNICATES_WITH",
}

# Canonical entities by type and their other names.
REGISTRY = {
    "Service": {
        "Amazon EC2": ["EC2", "Elastic Compute Cloud", "EC2 instance", "AWS EC2"],
        "Amazon S3": ["S3", "Simple Storage Service", "S3 bucket", "AWS S3"],
        "Amazon DynamoDB": ["DynamoDB", "AWS DynamoDB"],
        "Amazon RDS": ["RDS", "Relational Database Service", "AWS RDS"],
        "AWS Lambda": ["Lambda", "Lambda function", "AWS Lambda"],
        "Amazon VPC": ["VPC", "Virtual Private Cloud", "AWS VPC"],
        "AWS Transit Gateway": ["TGW", "Transit Gateway", "AWS Transit Gateway"],
        "AWS Direct Connect": ["DX", "DirectConnect", "AWS Direct Connect"],
        "AWS Site-to-Site VPN": ["VPN", "IPSec VPN", "Site-to-Site", "AWS VPN"],
        "AWS Client VPN": ["Client VPN", "AWS Client VPN"],
        "AWS IAM": ["IAM", "Identity and Access Management", "AWS IAM"],
        "AWS CloudWatch": ["CloudWatch", "AWS CloudWatch"],
        "AWS CloudTrail": ["CloudTrail", "AWS CloudTrail"],
        "Amazon Route 53": ["Route53", "Route 53", "R53", "AWS Route 53"],
        "Elastic Load Balancing": ["ELB", "ALB", "NLB", "CLB", "Load Balancer", "AWS ELB"],
        "AWS PrivateLink": ["PrivateLink", "VPC Endpoint", "AWS PrivateLink"],
        "Amazon CloudFront": ["CloudFront", "CDN", "AWS CloudFront"],
        "AWS EKS": ["EKS", "Elastic Kubernetes Service", "AWS EKS"],
        "Amazon SNS": ["SNS", "AWS SNS"],
        "Amazon SQS": ["SQS", "AWS SQS"],
        "Amazon Kinesis": ["Kinesis", "AWS Kinesis"],
        "AWS KMS": ["KMS", "Key Management Service", "AWS KMS"],
        "AWS Organizations": ["Organizations", "AWS Organizations"],
        "AWS Control Tower": ["Control Tower", "AWS Control Tower"],
        "AWS Backup": ["Backup", "AWS Backup"],
        "AWS Elastic Disaster Recovery": ["DRS", "Elastic Disaster Recovery", "AWS DRS"],
        "Amazon GuardDuty": ["GuardDuty", "AWS GuardDuty"],
        "AWS WAF": ["WAF", "Web Application Firewall", "AWS WAF"],
        "AWS Shield": ["Shield", "AWS Shield"],
        "AWS Certificate Manager": ["ACM", "Certificate Manager", "AWS ACM"],
        "AWS IAM Identity Center": ["IAM Identity Center", "SSO", "AWS SSO"],
        "Amazon Cognito": ["Cognito", "AWS Cognito"],
    },
    "Component": {
        "EBS Volume": ["EBS", "Volume"],
        "VPC Subnet": ["Subnet", "VPC Subnet"],
        "Security Group": ["SG", "Security Group"],
        "Network ACL": ["NACL", "Network ACL"],
        "NAT Gateway": ["NAT", "NATGW"],
        "Internet Gateway": ["IGW", "Internet Gateway"],
        "Route Table": ["Route Table"],
        "Elastic IP": ["EIP", "Elastic IP"],
        "VPC Endpoint": ["Endpoint", "VPC Endpoint"],
    },
    "Pattern": {
        "Multi-AZ Deployment": ["Multi-AZ", "Multi Availability Zone", "Multi-AZ Pattern"],
        "Blue-Green Deployment": ["Blue Green", "Blue/Green"],
        "Canary Deployment": ["Canary"],
        "Hub and Spoke": ["Hub-and-Spoke", "Hub & Spoke"],
        "Serverless": ["Serverless Architecture"],
    },
    "Pillar": {
        "Operational Excellence": ["Ops Excellence", "Operational Excellence Pillar"],
        "Security": ["Security Pillar"],
        "Reliability": ["Reliability Pillar"],
        "Performance Efficiency": ["Performance Efficiency Pillar", "Performance"],
        "Cost Optimization": ["Cost Optimization Pillar", "Cost"],
    },
}

# Words about a name that do not tell it apart.
NAME_PREFIX, NAME_SUFFIX = r"^(aws|amazon)\s+", r"\s+(service|aws|amazon)$"
SERVICE_SUFFIXES = [" bucket", " instance", " volume", " gateway", " endpoint"]


def rule_table(spark: SparkSession, rules: dict[str, tuple[list[str], list[str]]] = RULES) -> DataFrame:
    """subject_type, relation, object_type: a row for each combination that is allowed."""
    return spark.createDataFrame([(s, r, o) for r, (ss, oo) in rules.items() for s in ss for o in oo], "subject_type string, relation string, object_type string")


def registry_table(spark: SparkSession, registry: dict[str, dict[str, list[str]]] = REGISTRY) -> DataFrame:
    """name, entity_type, synonyms, priority; a later type has the greater priority."""
    order = {t: k for k, t in enumerate([*ENTITY_TYPES, *PLAIN_ENTITY_TYPES])}
    rows = [(n, t, s, order.get(t, len(order))) for t, names in registry.items() for n, s in names.items()]
    return spark.createDataFrame(rows, "name string, entity_type string, synonyms array<string>, priority int")


def paraphrase_table(spark: SparkSession, paraphrases: dict[str, list[str]] = PARAPHRASES) -> DataFrame:
    """paraphrase, relation."""
    return spark.createDataFrame([(p, r) for r, ps in paraphrases.items() for p in ps], "paraphrase string, relation string")


def service_vocabulary(spark: SparkSession, terms: dict[str, list[str]] = SERVICE_TERMS) -> DataFrame:
    """category, name, term, ordinal: the other names of a service before its own."""
    rows = [(n, t) for n, ts in terms.items() for t in [*ts, n]]
    return spark.createDataFrame([("service", n, t, k) for k, (n, t) in enumerate(rows)], "category string, name string, term string, ordinal int")


def technology_vocabulary(spark: SparkSession, terms: dict[str, str] = TECHNOLOGY_TERMS) -> DataFrame:
    return spark.createDataFrame([("technology", n, t, k) for k, (t, n) in enumerate(terms.items())], "category string, name string, term string, ordinal int")
